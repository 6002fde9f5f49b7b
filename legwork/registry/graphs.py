"""Social graph metrics and message series."""

from pyspark.sql import functions as F

from legwork.functions.scalars import log10_plus
from legwork.operators import graph, profile, series
from legwork.registry.base import cte, day_text, query, rounded, sql
from legwork.schemas import LANGUAGE_COUNTRIES
from legwork.session import cut_lineage
from legwork.sources import views

cte("pairs", "SELECT DISTINCT least(user_id, k) AS a, greatest(user_id, k) AS b FROM ev WHERE user_id <> k", ["ev"])
cte("adj", "SELECT a AS src, b AS dst FROM pairs UNION ALL SELECT b, a FROM pairs", ["pairs"])
cte("ids", "SELECT unnest(range((SELECT max(c_custkey) + 1 FROM customer))) AS id")
cte("deg", "SELECT id, count(src) AS degree FROM ids LEFT JOIN adj ON src = id GROUP BY id", ["ids", "adj"])
cte("nodes", """
SELECT c_custkey AS id, CASE WHEN c_custkey % 17 = 0 THEN 1 ELSE 0 END AS dead_account,
  ['EN','DE','FR','ES','NL','OTHER'][c_nationkey % 6 + 1] AS language, CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS affiliate_status,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS explicit_content,
  CAST(floor(greatest(c_acctbal, 0)) AS BIGINT) AS view_count, c_custkey * 37 % 2000 AS account_lifetime FROM customer""")
_REACH = "WITH RECURSIVE "


def _recursive(statement):
    return statement.replace("WITH ", _REACH, 1)


def pairs_and_ids(spark, d):
    pairs = cut_lineage(graph.undirected(views.edges(spark, d)))
    return pairs, cut_lineage(graph.all_ids(views.nodes(spark, d)))


@query("adjacency", sql(["adj"], "SELECT src, dst FROM adj"))
def adjacency(spark, d):
    return graph.both_ways(graph.undirected(views.edges(spark, d)))


@query("degree", sql(["deg"], "SELECT id, CAST(degree AS BIGINT) AS degree FROM deg"))
def degree(spark, d):
    return graph.degrees(graph.undirected(views.edges(spark, d)), graph.all_ids(views.nodes(spark, d)))


@query("degree_summary", sql(["deg"], """
SELECT round(avg(degree), 6) AS mean, CAST(max(degree) AS BIGINT) AS max, round(quantile_cont(degree, 0.5), 6)::DOUBLE AS median FROM deg"""))
def degree_summary(spark, d):
    found = graph.degree_summary(degree(spark, d))
    return found.select(*rounded("mean"), "max", *rounded("median"))


_COMPONENT = "SELECT id, min(root) AS component FROM reach GROUP BY id"
_REACH_CTE = "SELECT id, id AS root FROM ids UNION SELECT adj.dst, reach.root FROM reach JOIN adj ON adj.src = reach.id"


@query("components", _recursive(sql(["adj", "ids"], _COMPONENT, reach=_REACH_CTE)))
def components(spark, d):
    pairs, ids = pairs_and_ids(spark, d)
    return graph.components(pairs, ids)


@query("network_summary", _recursive(sql(["adj", "ids", "pairs"], """
SELECT (SELECT count(*) FROM ids) AS n_nodes, (SELECT count(*) FROM pairs) AS n_edges,
  round(2.0 * (SELECT count(*) FROM pairs) / ((SELECT count(*) FROM ids) * ((SELECT count(*) FROM ids) - 1.0)), 9)::DOUBLE AS density,
  count(*) AS n_components, max(size) AS largest_component, min(size) AS smallest_component,
  (SELECT string_agg(size, ',' ORDER BY size DESC) FROM (SELECT size FROM sizes ORDER BY size DESC LIMIT 5)) AS top_sizes,
  CASE WHEN count(*) = 1 THEN 1 ELSE 0 END AS is_connected
FROM sizes""", reach=_REACH_CTE, labels=_COMPONENT, sizes="SELECT component, count(*) AS size FROM labels GROUP BY component")))
def network_summary(spark, d):
    pairs, ids = pairs_and_ids(spark, d)
    found = graph.network_summary(pairs, ids, graph.components(pairs, ids))
    return found.withColumn("density", F.round("density", 9))


cte("tri", """
SELECT x.src AS id, count(*) AS links FROM adj x JOIN adj y ON y.src = x.src JOIN adj z ON z.src = x.dst AND z.dst = y.dst GROUP BY x.src""", ["adj"])


@query("clustering_coeff", sql(["deg", "tri"], """
SELECT id, CAST(degree AS BIGINT) AS degree, round(CASE WHEN degree < 2 THEN 0 ELSE coalesce(links, 0) / (degree * (degree - 1)) END, 9) AS clustering_coeff
FROM deg LEFT JOIN tri USING (id)"""))
def clustering_coeff(spark, d):
    pairs, ids = pairs_and_ids(spark, d)
    return graph.clustering(pairs, ids).select("id", "degree", *rounded("clustering_coeff", digits=9))


ROUNDS = 15


def _rank_sql(rounds):
    parts = {"r0": "SELECT id, 1.0::DOUBLE / (SELECT count(*) FROM ids) AS pr FROM ids"}
    for i in range(1, rounds + 1):
        parts[f"r{i}"] = f"""
SELECT d.id, 0.85 * coalesce(g.got, 0) + 0.85 * (SELECT coalesce(sum(pr), 0) FROM r{i-1} JOIN deg USING (id) WHERE degree = 0) / (SELECT count(*) FROM ids)
  + 0.15::DOUBLE / (SELECT count(*) FROM ids) AS pr
FROM deg d LEFT JOIN (SELECT adj.dst AS id, sum(pr / degree) AS got FROM adj JOIN r{i-1} ON r{i-1}.id = adj.src JOIN deg ON deg.id = adj.src GROUP BY adj.dst) g USING (id)"""
    made = sql(["deg"], f"SELECT id, round(pr, 9) AS pagerank FROM r{rounds}", **parts)
    for i in range(rounds + 1):
        made = made.replace(f"r{i} AS (", f"r{i} AS MATERIALIZED (", 1)
    return made.replace("deg AS (", "deg AS MATERIALIZED (", 1).replace("adj AS (", "adj AS MATERIALIZED (", 1)


@query("pagerank_fixed", _rank_sql(ROUNDS))
def pagerank_fixed(spark, d):
    pairs, ids = pairs_and_ids(spark, d)
    return graph.pagerank(pairs, ids, max_rounds=ROUNDS, tolerance=None).select("id", *rounded("pagerank", digits=9))


def _core_sql(rounds):
    """Repeated h-index; enough rounds to settle on the check tables."""
    parts = {"h0": "SELECT id, degree AS c FROM deg"}
    for i in range(1, rounds + 1):
        parts[f"h{i}"] = f"""
SELECT p.id, least(p.c, coalesce(g.h, 0)) AS c FROM h{i-1} p LEFT JOIN (
  SELECT id, max(least(c, rn)) AS h FROM (
    SELECT adj.src AS id, v.c, row_number() OVER (PARTITION BY adj.src ORDER BY v.c DESC) AS rn FROM adj JOIN h{i-1} v ON v.id = adj.dst)
  GROUP BY id) g ON g.id = p.id"""
    made = sql(["deg"], f"SELECT id, CAST(c AS BIGINT) AS core_number FROM h{rounds}", **parts)
    for i in range(rounds + 1):
        made = made.replace(f"h{i} AS (", f"h{i} AS MATERIALIZED (", 1)
    return made.replace("deg AS (", "deg AS MATERIALIZED (", 1).replace("adj AS (", "adj AS MATERIALIZED (", 1)


@query("core_number", _core_sql(40))
def core_number(spark, d):
    pairs, ids = pairs_and_ids(spark, d)
    return graph.core_numbers(pairs, ids)


@query("enhanced_nodes")
def enhanced_nodes(spark, d):
    found = graph.enhanced_nodes(views.nodes(spark, d), graph.undirected(views.edges(spark, d)))
    return found.withColumns({c: F.round(c, 6) for c in ("clustering_coeff", "pagerank")})


_STATS = ("SELECT '{c}' AS item, 'mean' AS measure, avg({c}) AS value FROM nodes UNION ALL SELECT '{c}', 'median', quantile_cont({c}, 0.5) FROM nodes "
          "UNION ALL SELECT '{c}', 'skew', skewness({c}) FROM nodes")


@query("dataset_summary", sql(["nodes"], f"""
SELECT item, measure, round(value, 6) AS value FROM (
  {' UNION ALL '.join(f"SELECT '{c}' AS item, 'positive_pct' AS measure, avg({c}) * 100 AS value FROM nodes" for c in ('affiliate_status', 'explicit_content', 'dead_account'))}
  UNION ALL {_STATS.format(c='view_count')} UNION ALL {_STATS.format(c='account_lifetime')}
  UNION ALL SELECT * FROM (SELECT language, 'language_pct', count(*) * 100.0 / (SELECT count(*) FROM nodes) FROM nodes GROUP BY language ORDER BY count(*) DESC, language LIMIT 3))"""))
def dataset_summary(spark, d):
    return graph.dataset_summary(views.nodes(spark, d)).select("item", "measure", *rounded("value"))


_COUNTRY = " UNION ALL ".join(
    f"SELECT '{code}' AS language, '{c}' AS country" for code, listed in LANGUAGE_COUNTRIES.items() for c in listed)


@query("country_users", sql(["nodes"], f"""
SELECT country, CAST(count(*) AS BIGINT) AS users FROM nodes JOIN ({_COUNTRY}) USING (language) GROUP BY country"""))
def country_users(spark, d):
    return graph.country_users(views.nodes(spark, d))


@query("log_view_histogram", sql(["nodes"], """
SELECT CAST(r.bin AS INTEGER) AS bin, CAST(coalesce(n, 0) AS BIGINT) AS rows FROM (SELECT unnest(range(50)) AS bin) r
LEFT JOIN (SELECT least(CAST(floor((x - lo) * 50 / (hi - lo)) AS INTEGER), 49) AS bin, count(*) AS n FROM logs, (SELECT min(x) AS lo, max(x) AS hi FROM logs) GROUP BY 1) USING (bin)""",
    logs="SELECT log10(view_count + 1) AS x FROM nodes"))
def log_view_histogram(spark, d):
    logs = views.nodes(spark, d).select(log10_plus(F.col("view_count")).alias("x"))
    return profile.histogram(logs, "x", 50).select("bin", "rows")


def log(spark, d):
    return views.with_datetime(views.messages(spark, d))


@query("edge_weights", sql(["ev"], "SELECT user_id AS src, CAST(k AS BIGINT) AS dst, CAST(count(*) AS BIGINT) AS weight FROM ev GROUP BY ALL"))
def edge_weights(spark, d):
    return series.edge_weights(log(spark, d))


@query("in_out_top", sql(["ev"], """
SELECT * FROM (SELECT 'out' AS role, user_id AS person, count(DISTINCT k) AS degree FROM ev GROUP BY user_id ORDER BY degree DESC, person LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'in', CAST(k AS BIGINT) AS person, count(DISTINCT user_id) AS degree FROM ev GROUP BY k ORDER BY degree DESC, person LIMIT 10)"""))
def in_out_top(spark, d):
    return series.degree_leaders(series.edge_weights(log(spark, d)))


_WEEK = "(CAST(ts AS DATE) + CAST(7 - isodow(ts) AS INTEGER))"


@query("weekly_edges", sql(["ev"], f"""
SELECT strftime({_WEEK}, '%Y-%m-%d') AS week, user_id AS src, CAST(k AS BIGINT) AS dst, CAST(count(*) AS BIGINT) AS weight FROM ev GROUP BY ALL"""))
def weekly_edges(spark, d):
    return series.weekly_edges(log(spark, d)).withColumn("week", day_text("week"))


def _series_sql(label, step):
    return sql([], f"""
SELECT strftime(label, '%Y-%m-%d') AS label, CAST(coalesce(n, 0) AS BIGINT) AS num_messages
FROM (SELECT CAST(unnest(generate_series(CAST(min(label) AS TIMESTAMP), CAST(max(label) AS TIMESTAMP), INTERVAL {step} DAY)) AS DATE) AS label FROM counts)
LEFT JOIN counts USING (label)""", counts=f"SELECT {label} AS label, count(*) AS n FROM events GROUP BY 1")


@query("daily_counts", _series_sql("CAST(ts AS DATE)", 1))
def daily_counts(spark, d):
    return series.daily_counts(log(spark, d)).withColumn("label", day_text("label"))


@query("weekly_counts", _series_sql(_WEEK, 7))
def weekly_counts(spark, d):
    return series.weekly_counts(log(spark, d)).withColumn("label", day_text("label"))


@query("hour_counts", "SELECT CAST(hour(ts) AS INTEGER) AS hour, CAST(count(*) AS BIGINT) AS num_messages FROM events GROUP BY 1")
def hour_counts(spark, d):
    return series.hour_counts(log(spark, d))
