"""Quality profiles, histograms, correlations."""

from pyspark.sql import functions as F

from legwork import schemas
from legwork.functions.scalars import to_number
from legwork.operators import profile
from legwork.registry.base import TS, legs, query, raw, rounded, sql, text
from legwork.sources import views

_RAW = ["FlightID", *schemas.RAW_LEG_TYPES]
_MIXED = """SELECT doc_id, lang, source, text, n_chars, quality, toxic,
  CASE WHEN doc_id % 10 = 0 THEN 'nan'::DOUBLE WHEN doc_id % 15 = 1 THEN 'infinity'::DOUBLE WHEN doc_id % 21 = 2 THEN NULL ELSE n_chars / 2.0 END AS half,
  CASE WHEN doc_id % 9 = 0 THEN '  ' WHEN doc_id % 9 = 1 THEN '' ELSE lang END AS note, 7 AS constant
FROM documents LEFT JOIN labels USING (doc_id)"""


def mixed(spark, d):
    """Documents with their labels and a few columns that hold every kind of defect."""
    doc = F.col("doc_id")
    return (
        views.table(spark, d, "documents")
        .join(views.table(spark, d, "labels"), "doc_id", "left")
        .select(
            "doc_id", "lang", "source", "text", "n_chars", "quality", "toxic",
            F.when(doc % 10 == 0, float("nan")).when(doc % 15 == 1, float("inf"))
            .when(doc % 21 == 2, None).otherwise(F.col("n_chars") / 2.0).alias("half"),
            F.when(doc % 9 == 0, "  ").when(doc % 9 == 1, "").otherwise(F.col("lang")).alias("note"),
            F.lit(7).alias("constant"),
        )
    )


def _union(names, template, table):
    return " UNION ALL ".join(template.format(c=c, q=f'"{c}"', t=table) for c in names)


@query("null_profile", sql(["raw"], _union(
    _RAW, "SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {q} IS NULL) AS BIGINT) AS null_count, "
          "round(count(*) FILTER (WHERE {q} IS NULL) / greatest(count(*), 1), 6) AS null_rate FROM {t}", "raw")))
def null_profile(spark, d):
    return profile.null_profile(raw(spark, d)).select("column", "null_count", *rounded("null_rate"))


@query("nan_profile", sql([], _union(
    ["half"], "SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE isnan({q})) AS BIGINT) AS nan_count, "
              "round(count(*) FILTER (WHERE isnan({q})) / count(*), 6) AS nan_rate, "
              "CAST(count(*) FILTER (WHERE isinf({q})) AS BIGINT) AS infinite_count, "
              "round(count(*) FILTER (WHERE isinf({q})) / count(*), 6) AS infinite_rate FROM {t}", "mixed"), mixed=_MIXED))
def nan_profile(spark, d):
    found = profile.nan_profile(mixed(spark, d))
    return found.select("column", "nan_count", "infinite_count", *rounded("nan_rate", "infinite_rate"))


@query("blank_strings", sql([], _union(
    ["lang", "source", "text", "note"],
    "SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE trim({q}, ' \t\n\r') = '') AS BIGINT) AS blank_string_count, "
    "round(count(*) FILTER (WHERE trim({q}, ' \t\n\r') = '') / count(*), 6) AS blank_string_rate FROM {t}", "mixed"), mixed=_MIXED))
def blank_strings(spark, d):
    found = profile.blank_profile(mixed(spark, d))
    return found.select("column", "blank_string_count", *rounded("blank_string_rate"))


@query("duplicate_counts", """
SELECT 'document text' AS what, CAST(sum(n) AS BIGINT) AS rows, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicated,
  CAST(sum(n - 1) AS BIGINT) AS extra FROM (SELECT count(*) AS n FROM documents GROUP BY text)
UNION ALL
SELECT 'line key', CAST(sum(n) AS BIGINT), CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT), CAST(sum(n - 1) AS BIGINT)
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL
SELECT 'customer row', CAST(sum(n) AS BIGINT), CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT), CAST(sum(n - 1) AS BIGINT)
FROM (SELECT count(*) AS n FROM customer GROUP BY ALL, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)""".replace("GROUP BY ALL, ", "GROUP BY "))
def duplicate_counts(spark, d):
    def counted(what, name, keys):
        return profile.duplicate_counts(views.table(spark, d, name), keys).select(
            F.lit(what).alias("what"), "rows", "duplicated", "extra")
    return (
        counted("document text", "documents", ["text"])
        .union(counted("line key", "lineitem", ["l_orderkey", "l_linenumber"]))
        .union(counted("customer row", "customer", None))
    )


@query("constant_columns", sql(["raw"], f"""
SELECT * FROM ({_union(_RAW, "SELECT '{c}' AS \"column\", count(DISTINCT {q}) + max(CASE WHEN {q} IS NULL THEN 1 ELSE 0 END) AS unique_count FROM {t}", "raw")})
WHERE unique_count <= 1"""))
def constant_columns(spark, d):
    return profile.constant_columns(raw(spark, d))


@query("unique_profile", sql([], _union(
    ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
    "SELECT '{c}' AS \"column\", CAST(count(DISTINCT {q}) AS BIGINT) AS unique_values, "
    "CAST(count(*) FILTER (WHERE {q} IS NULL) AS BIGINT) AS nan_values, "
    "(SELECT CAST(v AS VARCHAR) FROM (SELECT {q} AS v, count(*) AS n FROM {t} GROUP BY 1) ORDER BY n DESC, CAST(v AS VARCHAR) DESC LIMIT 1) AS mode, "
    "round((SELECT max(n) FROM (SELECT count(*) AS n FROM {t} GROUP BY {q})) / count(*), 6) AS mode_share FROM {t}", "orders")))
def unique_profile(spark, d):
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    found = profile.unique_profile(views.table(spark, d, "orders"), names)
    return found.select("column", "unique_values", "nan_values", "mode", *rounded("mode_share"))


_COUNTED = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"]


@query("distinct_counts", sql([], _union(
    _COUNTED, "SELECT '{c}' AS \"column\", CAST(count(DISTINCT {q}) AS BIGINT) AS unique_values, "
              "CAST(count(*) FILTER (WHERE {q} IS NULL) AS BIGINT) AS nan_values FROM {t}", "lineitem")))
def distinct_counts(spark, d):
    """Distinct values by bitmaps where the range allows it."""
    return profile.distinct_counts(views.table(spark, d, "lineitem"), _COUNTED)


@query("numeric_profile", _union(
    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    "SELECT '{c}' AS \"column\", CAST(min({q}) AS DOUBLE) AS \"min\", CAST(max({q}) AS DOUBLE) AS \"max\", round(avg({q}), 6) AS mean, "
    "round(stddev_samp({q}), 4) AS std, CAST(count(*) FILTER (WHERE {q} = 0) AS BIGINT) AS zero_count, "
    "CAST(count(*) FILTER (WHERE {q} < 0) AS BIGINT) AS negative_count FROM {t}", "lineitem"))
def numeric_profile(spark, d):
    found = profile.numeric_profile(views.table(spark, d, "lineitem"))
    return found.select("column", "min", "max", *rounded("mean"), *rounded("std", digits=4), "zero_count", "negative_count")


_ISSUES = [
    ("nulls", "null_values", "warning", ["doc_id", "lang", "source", "text", "n_chars", "quality", "toxic", "half", "note", "constant"], "{q} IS NULL"),
    ("NaNs", "nan_values", "error", ["half"], "isnan({q})"),
    ("infinite values", "infinite_values", "error", ["half"], "isinf({q})"),
    ("blank strings", "blank_strings", "warning", ["lang", "source", "text", "note"], "trim({q}, ' \t\n\r') = ''"),
]
_ISSUE_SQL = " UNION ALL ".join(
    f"SELECT '{severity}' AS severity, '{check}' AS \"check\", '{c}: ' || format('{{:,}}', n) || ' {what}' || printf(' (%.2f%%)', n * 100.0 / m) AS details "
    f"FROM (SELECT count(*) FILTER (WHERE " + test.format(q=f'"{c}"') + f") AS n, count(*) AS m FROM mixed) WHERE n > 0"
    for what, check, severity, names, test in _ISSUES for c in names
)


@query("issue_report", sql([], _ISSUE_SQL + """
UNION ALL SELECT 'warning', 'constant_column', 'constant: 1 unique value(s)' FROM (SELECT count(DISTINCT constant) AS n FROM mixed) WHERE n <= 1""",
    mixed=_MIXED))
def issue_report(spark, d):
    return profile.issue_report(mixed(spark, d))


_DESC = ("SELECT '{c}' AS \"column\", CAST(count({q}) AS BIGINT) AS \"count\", round(avg({q}), 6) AS mean, round(stddev_samp({q}), 6) AS std, "
         "CAST(min({q}) AS DOUBLE) AS \"min\", CAST(max({q}) AS DOUBLE) AS \"max\", round(skewness({q}), 6) AS skew, "
         "round(quantile_cont({q}, 0.25), 6) AS q1, round(quantile_cont({q}, 0.5), 6) AS median, round(quantile_cont({q}, 0.75), 6) AS q3 FROM {t}")


@query("describe", sql([], _union(["value", "user_id"], _DESC, "events")))
def describe(spark, d):
    found = profile.describe(views.table(spark, d, "events"), ["value", "user_id"])
    return found.select("column", "count", "min", "max", *rounded("mean", "std", "skew", "q1", "median", "q3"))


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corr_matrix", sql([], " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a in _CORR for b in _CORR)))
def corr_matrix(spark, d):
    return profile.correlation_matrix(views.table(spark, d, "lineitem"), _CORR).select("a", "b", *rounded("corr"))


@query("hist50", """
WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
b AS (SELECT least(CAST(floor((o_totalprice - lo) * 50 / (hi - lo)) AS INTEGER), 49) AS bin, count(*) AS n FROM orders, e GROUP BY 1)
SELECT CAST(r.bin AS INTEGER) AS bin, round(lo + r.bin * ((hi - lo) / 50), 6) AS left_edge, CAST(coalesce(n, 0) AS BIGINT) AS rows
FROM (SELECT unnest(range(50)) AS bin) r CROSS JOIN e LEFT JOIN b ON b.bin = r.bin""")
def hist50(spark, d):
    found = profile.histogram(views.table(spark, d, "orders"), "o_totalprice", 50)
    return found.select("bin", *rounded("left_edge"), "rows")


@query("hist2d", sql(["legs"], """
SELECT least(CAST(floor((Distance - x0) * 50 / (x1 - x0)) AS INTEGER), 49) AS x_bin,
  least(CAST(floor((ArrDelayMinutes - y0) * 50 / (y1 - y0)) AS INTEGER), 49) AS y_bin, CAST(count(*) AS BIGINT) AS rows
FROM kept, (SELECT min(Distance) AS x0, max(Distance) AS x1, min(ArrDelayMinutes) AS y0, max(ArrDelayMinutes) AS y1 FROM kept)
GROUP BY ALL""", kept="SELECT Distance, ArrDelayMinutes FROM legs WHERE Distance < 300 AND ArrDelayMinutes < 100"))
def hist2d(spark, d):
    return profile.histogram_2d(legs(spark, d), "Distance", "ArrDelayMinutes", 50, x_below=300, y_below=100)


@query("density_points", sql(["legs"], """
SELECT FlightID, round(density, 6) AS density FROM placed JOIN smooth USING (gx, gy)""",
    edges="SELECT min(Distance) AS x0, max(Distance) AS x1, min(ArrDelayMinutes) AS y0, max(ArrDelayMinutes) AS y1 FROM legs WHERE ArrDelayMinutes IS NOT NULL",
    placed="""
SELECT FlightID, least(CAST(floor((Distance - x0) * 100 / (x1 - x0)) AS INTEGER), 99) AS gx,
  least(CAST(floor((ArrDelayMinutes - y0) * 100 / (y1 - y0)) AS INTEGER), 99) AS gy
FROM legs, edges WHERE ArrDelayMinutes IS NOT NULL""",
    cells="SELECT gx, gy, count(*) AS c FROM placed GROUP BY ALL",
    kernel="SELECT j, exp(-0.5 * (j / 3.0) ** 2) / (SELECT sum(exp(-0.5 * (i / 3.0) ** 2)) FROM range(-12, 13) t(i)) AS w FROM range(-12, 13) k(j)",
    axis="SELECT t, CASE WHEN t + j < 0 THEN -(t + j) - 1 WHEN t + j > 99 THEN 199 - (t + j) ELSE t + j END AS src, w FROM range(100) r(t), kernel",
    pass1="SELECT a.t AS gx, c.gy, sum(c.c * a.w) AS v FROM cells c JOIN axis a ON a.src = c.gx GROUP BY ALL",
    smooth="SELECT p.gx, a.t AS gy, sum(p.v * a.w) AS density FROM pass1 p JOIN axis a ON a.src = p.gy GROUP BY ALL"))
def density_points(spark, d):
    rows = legs(spark, d).select("FlightID", "Distance", "ArrDelayMinutes")
    found = profile.point_density(rows, "Distance", "ArrDelayMinutes")
    return found.select("FlightID", *rounded("density"))


@query("quartiles_by_group", sql(["legs"], """
SELECT Reporting_Airline, round(quantile_cont(ArrDelayMinutes, 0.25), 6) AS q1, round(quantile_cont(ArrDelayMinutes, 0.5), 6) AS median,
  round(quantile_cont(ArrDelayMinutes, 0.75), 6) AS q3 FROM legs GROUP BY 1"""))
def quartiles_by_group(spark, d):
    found = profile.quartiles_by(legs(spark, d), "Reporting_Airline", "ArrDelayMinutes")
    return found.select("Reporting_Airline", *rounded("q1", "median", "q3"))


_KIND = {"bigint": "bigint", "string": "string", "double": "double"}
_CATEGORY = "CASE " + " ".join(
    "WHEN '{c}' IN (" + ", ".join(f"'{n}'" for n in names) + f") THEN '{label}'"
    for names, label in (
        (schemas.TIME_INFO_COLUMNS, "Time Info"), (schemas.LEG_INFO_COLUMNS, "Flight Information"),
        (schemas.TARGET_LIKE_COLUMNS, "Target Like"), (["ArrDelayMinutes"], "Target"),
    )
) + " ELSE 'Undefined' END"
_DROPPED = ", ".join(f"'{n}'" for n in schemas.FEATURE_TABLE_DROPS)


@query("column_catalogue", sql(["raw"], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{ {'FlightID': 'bigint', **schemas.RAW_LEG_TYPES}[c] }' AS data_type, CAST(count(DISTINCT \"{c}\") AS BIGINT) AS unique_values, "
    f"CAST(count(*) FILTER (WHERE \"{c}\" IS NULL) AS BIGINT) AS nan_values, CASE WHEN '{c}' IN ({_DROPPED}) THEN 1 ELSE 0 END AS dropped, "
    f"{_CATEGORY.replace('{c}', c)} AS category FROM raw" for c in _RAW)))
def column_catalogue(spark, d):
    return profile.column_catalogue(raw(spark, d))


@query("completed_nulls", sql(["legs"], f"""
SELECT "column", CAST(missing AS BIGINT) AS missing, CAST(really_missing AS BIGINT) AS really_missing,
  CASE WHEN really_missing > 0 AND "column" NOT IN ({', '.join(f"'{n}'" for n in schemas.NULLS_ALLOWED)}) THEN 1 ELSE 0 END AS problem
FROM ({_union(_RAW, "SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {q} IS NULL) AS missing, count(*) FILTER (WHERE {q} IS NULL AND Cancelled <> 1 AND Diverted <> 1) AS really_missing FROM {t}", "legs")})
WHERE missing > 0"""))
def completed_nulls(spark, d):
    return profile.completed_null_profile(legs(spark, d).select(*_RAW))


@query("top_k", """
SELECT lang || '/' || source AS item, CAST(count(*) AS BIGINT) AS rows, round(count(*) / (SELECT count(*) FROM documents), 6) AS share
FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def top_k(spark, d):
    items = views.table(spark, d, "documents").select(F.concat_ws("/", "lang", "source").alias("item"))
    return profile.value_counts(items, "item", 15).select("item", "rows", *rounded("share"))


@query("log_overview", f"""
SELECT CAST(count(*) AS BIGINT) AS messages, strftime(date_trunc('second', min(ts)), {TS}) AS first_at, strftime(date_trunc('second', max(ts)), {TS}) AS last_at,
  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT user_id FROM events UNION SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) FROM events)) AS people
FROM events""")
def log_overview(spark, d):
    from legwork.operators import series
    log = views.with_datetime(views.messages(spark, d))
    return series.overview(log).select(
        "messages", text("first_at").alias("first_at"), text("last_at").alias("last_at"), "people")


@query("column_selection", sql(["raw"], f"""
SELECT "column" FROM ({_union(_RAW, "SELECT '{c}' AS \"column\", count(DISTINCT {q}) AS u, count(*) FILTER (WHERE {q} IS NULL) AS n FROM {t}", "raw")})
WHERE n = 0 AND u BETWEEN 2 AND 50"""))
def column_selection(spark, d):
    """Columns without nulls that hold 2 to 50 distinct values."""
    rows = raw(spark, d)
    kept = profile.keep_columns(rows, no_nulls=True, min_unique=2, max_unique=50)
    return profile.schema_report(rows.select(*kept)).select("column")


@query("numeric_coercion", """
SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS priority, TRY_CAST(o_orderstatus AS DOUBLE) AS status FROM orders""")
def numeric_coercion(spark, d):
    """Text to number, null where it does not parse."""
    return views.table(spark, d, "orders").select(
        "o_orderkey",
        to_number(F.split("o_orderpriority", "-")[0]).alias("priority"),
        to_number(F.col("o_orderstatus")).alias("status"),
    )
