"""Splits, samples, scaling, encoding, class weights."""

from pyspark.sql import functions as F

from legwork.operators import encode, scale, split, target
from legwork.registry.base import TS, cte, legs, query, rounded, sql, text
from legwork.session import cut_to_table
from legwork.sources import views

_HASH = "(({id}) * 2654435761 % 4294967296)"
cte("ranked", """
SELECT *, row_number() OVER (ORDER BY CRSDepDateTime_UTC, FlightID) - 1 AS pos, count(*) OVER () AS n FROM legs""", ["legs"])
cte("split_legs", """
SELECT *, CASE WHEN pos < floor(n * 0.7::DOUBLE) THEN 'train' WHEN pos < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split
FROM ranked""", ["ranked"])
cte("labelled", """
SELECT *, CASE WHEN ArrDelayMinutes <= 15 THEN 0 WHEN ArrDelayMinutes <= 60 THEN 1 WHEN ArrDelayMinutes <= 180 THEN 2 ELSE 3 END AS label
FROM legs WHERE ArrDelayMinutes IS NOT NULL""", ["legs"])


def labelled(spark, d):
    rows = target.add_delay_class(legs(spark, d))
    return target.encode_label(rows).withColumn("label", F.col("label").cast("int"))


def split_legs(spark, d):
    return split.chronological_split(legs(spark, d), "CRSDepDateTime_UTC", "FlightID")


@query("chrono_split", sql(["split_legs"], "SELECT FlightID, split FROM split_legs"))
def chrono_split(spark, d):
    return split_legs(spark, d).select("FlightID", "split")


@query("split_summary", sql(["split_legs"], f"""
SELECT split, CAST(count(*) AS BIGINT) AS rows, strftime(min(CRSDepDateTime_UTC), {TS}) AS start, strftime(max(CRSDepDateTime_UTC), {TS}) AS "end"
FROM split_legs GROUP BY split"""))
def split_summary(spark, d):
    found = split.split_summary(split_legs(spark, d), "CRSDepDateTime_UTC")
    return found.select("split", "rows", text("start").alias("start"), text("end").alias("end"))


@query("threshold_split", """
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1999-01-02 00:00:00' THEN 'train' ELSE 'test' END AS split FROM orders""")
def threshold_split(spark, d):
    orders = views.table(spark, d, "orders")
    return split.threshold_split(orders, "o_orderdate", "1999-01-02 00:00:00").select("o_orderkey", "split")


@query("time_folds", sql(["ranked"], """
SELECT FlightID, CAST(CASE WHEN pos < n - 3 * (n // 4) THEN 0 ELSE 1 + (pos - (n - 3 * (n // 4))) // (n // 4) END AS INTEGER) AS block FROM ranked"""))
def time_folds(spark, d):
    return split.time_folds(legs(spark, d), "CRSDepDateTime_UTC", "FlightID", 3).select("FlightID", "block")


_STRATA = f"""SELECT FlightID, label, row_number() OVER (PARTITION BY label ORDER BY {_HASH.format(id='FlightID')}, FlightID) - 1 AS pos,
  count(*) OVER (PARTITION BY label) AS n FROM labelled"""


@query("stratified_split", sql(["labelled"], """
SELECT FlightID, label, CASE WHEN pos < floor(n * 0.7::DOUBLE) THEN 'train' WHEN pos < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split
FROM strata""", strata=_STRATA))
def stratified_split(spark, d):
    return split.stratified_split(labelled(spark, d), "label", "FlightID").select("FlightID", "label", "split")


@query("stratified_folds", sql(["labelled"], """
SELECT FlightID, label, CAST(CASE WHEN pos >= ceil(n * 2 / 3) THEN 2 WHEN pos >= ceil(n / 3) THEN 1 ELSE 0 END AS INTEGER) AS fold FROM strata""", strata=_STRATA))
def stratified_folds(spark, d):
    return split.stratified_folds(labelled(spark, d), "label", "FlightID", 3).select("FlightID", "label", "fold")


@query("hash_sample", f"SELECT event_id, event_type FROM events WHERE {_HASH.format(id='event_id')} < 0.1 * 4294967296")
def hash_sample(spark, d):
    return split.hash_sample(views.table(spark, d, "events"), "event_id", 0.1).select("event_id", "event_type")


@query("hash_sample_n", f"SELECT event_id, event_type FROM events ORDER BY {_HASH.format(id='event_id')}, event_id LIMIT 500")
def hash_sample_n(spark, d):
    return split.hash_sample_n(views.table(spark, d, "events"), "event_id", 500).select("event_id", "event_type")


_SCALED = ["CRSElapsedTime", "Distance", "ArrDelayMinutes", "SecurityDelay"]


def _scaled(spark, d, kind, **options):
    rows = split_legs(spark, d).fillna(0.0, subset=_SCALED)
    params = scale.fit_scaler(rows.filter("split = 'train'"), _SCALED, kind, **options)
    return scale.apply_scaler(rows, params, _SCALED).select("FlightID", "split", *rounded(*_SCALED))


def _scaled_sql(center, width):
    fits = ", ".join(f"{center.format(c=c)} AS c_{c}, {width.format(c=c)} AS w_{c}" for c in _SCALED)
    cols = ", ".join(f"round((coalesce({c}, 0) - c_{c}) / CASE WHEN w_{c} = 0 THEN 1 ELSE w_{c} END, 6) AS {c}" for c in _SCALED)
    return sql(["split_legs"], f"SELECT FlightID, split, {cols} FROM split_legs, fit",
               fit=f"SELECT {fits} FROM split_legs WHERE split = 'train'")


@query("minmax_scale", _scaled_sql("min(coalesce({c}, 0))", "max(coalesce({c}, 0)) - min(coalesce({c}, 0))"))
def minmax_scale(spark, d):
    return _scaled(spark, d, "minmax")


@query("standard_scale", _scaled_sql("avg(coalesce({c}, 0))", "stddev_pop(coalesce({c}, 0))"))
def standard_scale(spark, d):
    return _scaled(spark, d, "standard")


@query("standard_scale_no_mean", _scaled_sql("0", "stddev_pop(coalesce({c}, 0))"))
def standard_scale_no_mean(spark, d):
    return _scaled(spark, d, "standard", with_mean=False)


@query("one_hot", sql(["legs"], "SELECT FlightID, " + ", ".join(
    [f"CASE WHEN Reporting_Airline = 'C{i}' THEN 1.0 ELSE 0.0 END::DOUBLE AS Reporting_Airline_C{i}" for i in range(5)]
    + [f"CASE WHEN Dest = 'A{i}' AND Origin <> 'A6' THEN 1.0 ELSE 0.0 END::DOUBLE AS Dest_A{i}" for i in range(7)]) + " FROM legs"))
def one_hot(spark, d):
    rows = legs(spark, d).select(
        "FlightID", "Reporting_Airline", F.when(F.col("Origin") == "A6", "new").otherwise(F.col("Dest")).alias("Dest")
    )
    known = encode.fit_categories(rows.filter("Dest <> 'new'"), ["Reporting_Airline", "Dest"])
    return encode.one_hot(rows, known)


_KEYED = ["Reporting_Airline", "Origin", "Dest", "Tail_Number"]
_DICTIONARY = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS index "
    f"FROM (SELECT DISTINCT {c} AS v FROM legs WHERE {c} IS NOT NULL)" for c in _KEYED)


@query("category_dictionary", sql(["legs"], _DICTIONARY))
def category_dictionary(spark, d):
    return encode.fit_dictionary(legs(spark, d), _KEYED)


@query("sparse_indicators", sql(["legs"], f"""
SELECT FlightID, {', '.join(f'{c}_d.index AS {c}_index' for c in _KEYED)} FROM legs
{' '.join(f'LEFT JOIN d AS {c}_d ON {c}_d."column" = {chr(39)}{c}{chr(39)} AND {c}_d.value = {c}' for c in _KEYED)}""",
    d=_DICTIONARY.replace("FROM legs WHERE", "FROM legs WHERE Dest <> 'A6' AND")))
def sparse_indicators(spark, d):
    """Place of each indicator; legs to A6 are not fitted, so a value seen there only has none."""
    rows = legs(spark, d).select("FlightID", *_KEYED)
    dictionary = cut_to_table(encode.fit_dictionary(rows.filter("Dest <> 'A6'"), _KEYED), "categories")
    coded, vectors = encode.one_hot_vectors(rows, dictionary, _KEYED)
    return coded.select("FlightID", *[encode.place_of(v).alias(f"{c}_index") for c, v in zip(_KEYED, vectors)])


@query("dummies_null", sql(["legs"], """
SELECT FlightID, CASE WHEN ArrTime IS NULL THEN NULL WHEN ArrDelay >= 15 THEN 1.0 ELSE 0.0 END::DOUBLE AS late_flag,
  CASE WHEN Tail_Number IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS tail_nan,
  CASE WHEN Tail_Number IS NOT NULL AND Origin < 'A3' THEN 1.0 ELSE 0.0 END::DOUBLE AS tail_west,
  CASE WHEN Tail_Number IS NOT NULL AND Origin >= 'A3' THEN 1.0 ELSE 0.0 END::DOUBLE AS tail_east FROM legs"""))
def dummies_null(spark, d):
    rows = legs(spark, d).select(
        "FlightID",
        F.when(F.col("ArrTime").isNotNull(), (F.col("ArrDelay") >= 15).cast("double")).alias("late_flag"),
        F.when(F.col("Tail_Number").isNotNull(), F.when(F.col("Origin") < "A3", "west").otherwise("east")).alias("tail"),
    )
    return encode.one_hot(rows, encode.fit_categories(rows, ["tail"]), null_column=True)


_MATRIX = ["Year", "Month", "DayofMonth", "DayOfWeek", "CRSDepTime", "CRSArrTime", "CRSElapsedTime", "Distance", "DistanceGroup"]


@query("feature_matrix", sql(["labelled"], f"""
SELECT FlightID, CAST(label AS VARCHAR) AS label, {', '.join(f'CAST(coalesce({c}, 0) AS DOUBLE) AS {c}' for c in _MATRIX)},
  {', '.join(f"CASE WHEN Reporting_Airline = 'C{i}' THEN 1.0 ELSE 0.0 END::DOUBLE AS Reporting_Airline_C{i}" for i in range(5))},
  0.0::DOUBLE AS Reporting_Airline_nan,
  {', '.join(f"CASE WHEN Origin = 'A{i}' THEN 1.0 ELSE 0.0 END::DOUBLE AS Origin_A{i}" for i in range(7))}, 0.0::DOUBLE AS Origin_nan
FROM labelled"""))
def feature_matrix(spark, d):
    rows = labelled(spark, d)
    extra = ["Tail_Number", "Dest", "TZ_Origin", "TZ_Dest", "Flight_Number_Reporting_Airline", "delay_class"]
    found = encode.feature_matrix(rows, "label", "CRSDepDateTime_UTC", "FlightID", extra)
    return found.withColumns({c: F.col(c).cast("double") for c in _MATRIX})


@query("class_weights", sql(["labelled"], """
SELECT label, CAST(count(*) AS BIGINT) AS rows,
  round((SELECT count(*) FROM labelled) / ((SELECT count(DISTINCT label) FROM labelled) * count(*)), 6) AS weight
FROM labelled GROUP BY label"""))
def class_weights(spark, d):
    return target.class_weights(labelled(spark, d)).select("label", "rows", *rounded("weight"))


@query("fixed_weight_sums", sql(["labelled"], """
SELECT label, round(sum(CASE label WHEN 0 THEN 0.3 WHEN 1 THEN 0.7 WHEN 2 THEN 1.0 ELSE 1.5 END), 4)::DOUBLE AS weighted_rows
FROM labelled GROUP BY label"""))
def fixed_weight_sums(spark, d):
    rows = labelled(spark, d)
    weighted = target.add_row_weight(rows, target.class_weights(rows, weights=None))
    return weighted.groupBy("label").agg(F.round(F.sum("weight"), 4).alias("weighted_rows"))
