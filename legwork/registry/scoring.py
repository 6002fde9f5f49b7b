"""Evaluation of predictions, run tables, nearest neighbours."""

from pyspark.sql import functions as F

from legwork.operators import evaluate, neighbors, reshape, runs, split, state
from legwork.registry.base import cte, legs, query, rounded, sql
from legwork.registry.shaping import labelled
from legwork.schemas import DELAY_CLASSES
from legwork.sources import views

cte("state_avg", """
SELECT l.FlightID, coalesce(sum(s.DepDelayMinutes) / sum(s.n), 0) AS feature FROM legs l
LEFT JOIN dep_counts s ON s.airport = l.Origin AND s.day = l.FlightDate AND s.hour <= l.floor_informationtime
GROUP BY l.FlightID""", ["legs", "dep_counts"])
cte("scored", """
SELECT FlightID, Reporting_Airline, Origin, label, CASE WHEN feature <= 15 THEN 0 WHEN feature <= 60 THEN 1 WHEN feature <= 180 THEN 2 ELSE 3 END AS pred,
  DepDelay, row_number() OVER (ORDER BY CRSDepDateTime_UTC, FlightID) - 1 AS pos, count(*) OVER () AS n
FROM labelled JOIN state_avg USING (FlightID)""", ["labelled", "state_avg"])
cte("scored3", """
SELECT *, Reporting_Airline || '-' || Origin AS run_id, Reporting_Airline AS model_name,
  CASE WHEN pos < floor(n * 0.7::DOUBLE) THEN 'train' WHEN pos < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split
FROM scored""", ["scored"])


def _stats(table, keys):
    """Per-class counts over all four classes for each key."""
    cols = ", ".join(keys)
    lead = cols + ", " if cols else ""
    base = f"(SELECT DISTINCT {cols} FROM {table})" if cols else "(SELECT 1)"
    using = f"USING ({lead}class)"
    return f"""
SELECT {lead}class, coalesce(tp, 0) AS tp, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted,
  CASE WHEN coalesce(predicted, 0) = 0 THEN 0 ELSE coalesce(tp, 0) / predicted END AS p,
  CASE WHEN coalesce(support, 0) = 0 THEN 0 ELSE coalesce(tp, 0) / support END AS r,
  CASE WHEN coalesce(support, 0) + coalesce(predicted, 0) = 0 THEN 0 ELSE 2 * coalesce(tp, 0) / (coalesce(support, 0) + coalesce(predicted, 0)) END AS f1,
  CASE WHEN 4 * coalesce(support, 0) + coalesce(predicted, 0) = 0 THEN 0 ELSE 5 * coalesce(tp, 0) / (4 * coalesce(support, 0) + coalesce(predicted, 0)) END AS f2
FROM {base} CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS class)
LEFT JOIN (SELECT {lead}label AS class, count(*) AS support, count(*) FILTER (WHERE label = pred) AS tp FROM {table} GROUP BY ALL) {using}
LEFT JOIN (SELECT {lead}pred AS class, count(*) AS predicted FROM {table} GROUP BY ALL) {using}"""


_HEAD = ", ".join(
    ["sum(tp) / sum(support) AS accuracy", "avg(r) FILTER (WHERE support > 0) AS balanced_accuracy", "avg(f1) AS macro_f1",
     "avg(f2) FILTER (WHERE support > 0 OR predicted > 0) AS macro_f2", "sum(f1 * support) / sum(support) AS weighted_f1"]
    + [f"max(p) FILTER (WHERE class = {i}) AS {n}_precision, max(r) FILTER (WHERE class = {i}) AS {n}_recall" for i, n in enumerate(DELAY_CLASSES)]
)
_NAMES = ["accuracy", "balanced_accuracy", "macro_f1", "macro_f2", "weighted_f1"] + [
    f"{n}_{p}" for n in DELAY_CLASSES for p in ("precision", "recall")]


def scored(spark, d):
    """Labelled legs with the rule prediction from the day-so-far departure delay."""
    rows = labelled(spark, d)
    joined = state.attach_state(rows, state.departures_state(legs(spark, d)))
    return joined.withColumn("prediction", evaluate.rule_class())


def scored_by_run(spark, d):
    """One run per airline and origin, each with chronological splits."""
    rows = split.chronological_split(scored(spark, d), "CRSDepDateTime_UTC", "FlightID")
    return rows.withColumns(
        {"run_id": F.concat_ws("-", "Reporting_Airline", "Origin"), "model_name": F.col("Reporting_Airline")}
    )


def run_metrics(spark, d, keys=("model_name", "run_id", "split")):
    counts = evaluate.pair_counts(scored_by_run(spark, d), keys)
    return evaluate.headline_metrics(evaluate.per_class(counts, keys), keys)


@query("rule_class", sql(["scored"], "SELECT FlightID, label, pred AS prediction FROM scored"))
def rule_class(spark, d):
    return scored(spark, d).select("FlightID", "label", "prediction")


@query("majority_class", sql(["labelled"], """
SELECT label, (SELECT label FROM labelled GROUP BY label ORDER BY count(*) DESC, label LIMIT 1) AS prediction, CAST(count(*) AS BIGINT) AS rows
FROM labelled GROUP BY label"""))
def majority_class(spark, d):
    rows = labelled(spark, d)
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("prediction", evaluate.majority_class(rows))


@query("confusion", sql(["scored"], """
SELECT l.c AS label, p.c AS prediction, CAST(count(s.FlightID) AS BIGINT) AS rows
FROM (SELECT unnest([0,1,2,3]) AS c) l CROSS JOIN (SELECT unnest([0,1,2,3]) AS c) p
LEFT JOIN scored s ON s.label = l.c AND s.pred = p.c GROUP BY ALL"""))
def confusion(spark, d):
    return evaluate.confusion(evaluate.pair_counts(scored(spark, d)))


@query("class_report", sql(["scored"], f"""
SELECT ['no_delay','small_delay','medium_delay','large_delay'][class + 1] AS name, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, round(support, 6)::DOUBLE AS support FROM stats
UNION ALL SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), round(a, 6) FROM (SELECT sum(tp) / sum(support) AS a FROM stats)
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), sum(support)::DOUBLE FROM stats
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::DOUBLE FROM stats""",
    stats=_stats("scored", [])))
def class_report(spark, d):
    report = evaluate.class_report(evaluate.per_class(evaluate.pair_counts(scored(spark, d))))
    return report.select("name", *rounded("precision", "recall", "f1", "support"))


@query("headline_metrics", sql(["scored3"], f"""
SELECT split, {', '.join(f'round({n}, 6) AS {n}' for n in _NAMES)} FROM (SELECT split, {_HEAD} FROM stats GROUP BY split)""",
    stats=_stats("scored3", ["split"])))
def headline_metrics(spark, d):
    return run_metrics(spark, d, ["split"]).select("split", *rounded(*_NAMES))


@query("fbeta", sql(["scored"], """
SELECT class, CAST(tp AS BIGINT) AS tp, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted, round(f1, 6) AS f1, round(f2, 6) AS f2 FROM stats""",
    stats=_stats("scored", [])))
def fbeta(spark, d):
    classes = evaluate.per_class(evaluate.pair_counts(scored(spark, d)))
    return classes.select("class", "tp", "support", "predicted",
                          F.round(evaluate.fbeta(1), 6).alias("f1"), F.round(evaluate.fbeta(2), 6).alias("f2"))


@query("weighted_metrics", """
WITH s AS (SELECT lang, quality AS label, CASE WHEN n_chars >= 300 AND n_chars <= 6000 THEN 1 ELSE 0 END AS pred FROM labels JOIN documents USING (doc_id)),
c AS (SELECT lang, class, (SELECT count(*) FROM s x WHERE x.lang = k.lang AND label = class AND pred = class) AS tp,
  (SELECT count(*) FROM s x WHERE x.lang = k.lang AND label = class) AS sup, (SELECT count(*) FROM s x WHERE x.lang = k.lang AND pred = class) AS pre
  FROM (SELECT DISTINCT lang FROM s) k CROSS JOIN (SELECT unnest([0, 1]) AS class))
SELECT lang, round(sum(tp) / sum(sup), 6) AS accuracy, round(sum(CASE WHEN pre = 0 THEN 0 ELSE tp / pre END * sup) / sum(sup), 6) AS precision,
  round(sum(CASE WHEN sup = 0 THEN 0 ELSE tp / sup END * sup) / sum(sup), 6) AS recall,
  round(sum(CASE WHEN sup + pre = 0 THEN 0 ELSE 2 * tp / (sup + pre) END * sup) / sum(sup), 6) AS f1 FROM c GROUP BY lang""")
def weighted_metrics(spark, d):
    counts = evaluate.pair_counts(views.scoring_pairs(spark, d), ["lang"])
    found = evaluate.weighted_metrics(evaluate.per_class(counts, ["lang"], (0, 1)), ["lang"])
    return found.select("lang", *rounded("accuracy", "precision", "recall", "f1"))


@query("roc_auc", """
WITH s AS (SELECT lang, quality AS y, n_chars AS score FROM labels JOIN documents USING (doc_id)),
r AS (SELECT *, rank() OVER (PARTITION BY lang ORDER BY score) + (count(*) OVER (PARTITION BY lang, score) - 1) / 2.0 AS rk FROM s)
SELECT lang, CAST(sum(y) AS BIGINT) AS positives,
  round(CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN (sum(rk) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) END, 6) AS roc_auc
FROM r GROUP BY lang""")
def roc_auc(spark, d):
    rows = views.scoring_pairs(spark, d)
    return evaluate.roc_auc(rows, ["lang"], F.col("label"), F.col("score")).select("lang", "positives", *rounded("roc_auc"))


_MIDDLES = {0: 0, 1: 37, 2: 120, 3: 240}


@query("roc_auc_ovr", sql(["labelled"], """
SELECT CAST(class AS VARCHAR) AS class, CAST(np AS BIGINT) AS positives, round(auc, 6) AS roc_auc FROM per
UNION ALL SELECT 'weighted', CAST(sum(np) AS BIGINT), round(sum(auc * np) / sum(np), 6) FROM per""",
    s="SELECT class, CASE WHEN label = class THEN 1 ELSE 0 END AS y, -abs(DepDelay - mid) AS score FROM labelled, (VALUES (0, 0), (1, 37), (2, 120), (3, 240)) m(class, mid)",
    r="SELECT *, rank() OVER (PARTITION BY class ORDER BY score) + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0 AS rk FROM s",
    per="SELECT class, sum(y) AS np, (sum(rk) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) AS auc FROM r GROUP BY class"))
def roc_auc_ovr(spark, d):
    scores = {c: -F.abs(F.col("DepDelay") - m) for c, m in _MIDDLES.items()}
    found = evaluate.roc_auc_ovr(labelled(spark, d), "label", scores)
    name = F.coalesce(F.col("class").cast("string"), F.lit("weighted"))
    return found.select(name.alias("class"), "positives", *rounded("roc_auc"))


_RUN_HEAD = f"SELECT model_name, run_id, split, {_HEAD} FROM stats GROUP BY ALL"
_RUN_STATS = _stats("scored3", ["model_name", "run_id", "split"])


@query("overfit_gaps", sql(["scored3"], """
SELECT t.run_id, 'train_minus_' || s.split || '_' || t.metric AS gap, round(t.value - s.value, 6) AS value
FROM long t JOIN long s ON s.run_id = t.run_id AND s.metric = t.metric AND t.split = 'train' AND s.split <> 'train'
WHERE t.value IS NOT NULL AND s.value IS NOT NULL""", stats=_RUN_STATS, heads=_RUN_HEAD,
    long=f"UNPIVOT heads ON {', '.join(_NAMES)} INTO NAME metric VALUE value"))
def overfit_gaps(spark, d):
    metrics = evaluate.long_metrics(run_metrics(spark, d), ["model_name", "run_id", "split"])
    return evaluate.overfit_gaps(metrics, ["run_id"]).select("run_id", "gap", *rounded("value"))


_BOARD = ["accuracy", "balanced_accuracy", "macro_f1", "macro_f2"]
_BOARD_COLUMNS = [f"{p}_{n}" for p in ("train", "val", "test") for n in _BOARD]
_BOARD_SQL = f"""SELECT model_name, run_id, """ + ", ".join(
    f"max({n}) FILTER (WHERE split = '{s}') AS {p}_{n}" for s, p in runs.SPLIT_PREFIX.items() for n in _BOARD
) + " FROM heads GROUP BY ALL"


def wide_runs(spark, d):
    metrics = evaluate.long_metrics(run_metrics(spark, d), ["model_name", "run_id", "split"])
    return runs.wide_runs(metrics, ["model_name", "run_id"], _BOARD)


@query("leaderboard", sql(["scored3"], f"""
SELECT model_name, run_id, {', '.join(f'round({c}, 6) AS {c}' for c in _BOARD_COLUMNS)},
  round(train_macro_f2 - test_macro_f2, 6) AS train_minus_test_macro_f2 FROM board""", stats=_RUN_STATS, heads=_RUN_HEAD, board=_BOARD_SQL))
def leaderboard(spark, d):
    return runs.leaderboard(wide_runs(spark, d)).select(
        "model_name", "run_id", *rounded(*_BOARD_COLUMNS, "train_minus_test_macro_f2"))


@query("best_by_model", sql(["scored3"], """
SELECT model_name, arg_max(run_id, test_macro_f2) AS run_id, round(max(test_macro_f2), 6) AS test_macro_f2,
  round(arg_max(train_accuracy, test_macro_f2), 6) AS train_accuracy FROM board GROUP BY model_name""", stats=_RUN_STATS, heads=_RUN_HEAD, board=_BOARD_SQL))
def best_by_model(spark, d):
    return runs.best_by_model(wide_runs(spark, d)).select("model_name", "run_id", *rounded("test_macro_f2", "train_accuracy"))


@query("best_row", """
SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def best_row(spark, d):
    orders = views.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")
    return reshape.best_rows(orders, "o_custkey", "o_totalprice", "o_orderkey")


@query("candidate_rank", """
SELECT p_partkey AS candidate_index, p_size AS rank_test_score, row_number() OVER (ORDER BY p_size, p_retailprice DESC, p_partkey) AS position,
  'tuned_model' || row_number() OVER (ORDER BY p_size, p_retailprice DESC, p_partkey) AS name FROM part""")
def candidate_rank(spark, d):
    results = views.table(spark, d, "part").select(
        F.col("p_partkey").alias("candidate_index"), F.col("p_size").alias("rank_test_score"),
        F.col("p_retailprice").alias("mean_test_score"))
    ranked = runs.rank_candidates(results)
    return ranked.select("candidate_index", "rank_test_score", F.col("position").cast("bigint").alias("position"), "name")


@query("melt_metrics", " UNION ALL ".join(
    f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, '{c}' AS measure, {c} AS amount FROM lineitem"
    for c in ("l_quantity", "l_discount", "l_tax")))
def melt_metrics(spark, d):
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return reshape.melt(views.table(spark, d, "lineitem"), ids, ["l_quantity", "l_discount", "l_tax"], "measure", "amount")


@query("pivot_status", """
SELECT o_orderpriority, round(max(t) FILTER (WHERE o_orderstatus = 'F'), 4) AS F, round(max(t) FILTER (WHERE o_orderstatus = 'O'), 4) AS O,
  round(max(t) FILTER (WHERE o_orderstatus = 'P'), 4) AS P
FROM (SELECT o_orderpriority, o_orderstatus, avg(o_totalprice) AS t FROM orders GROUP BY ALL) GROUP BY 1""")
def pivot_status(spark, d):
    means = views.table(spark, d, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.avg("o_totalprice").alias("t"))
    wide = reshape.widen(means, ["o_orderpriority"], "o_orderstatus", "t", ["F", "O", "P"])
    return wide.select("o_orderpriority", *rounded("F", "O", "P", digits=4))


_TRAIN = "(vec_id * 2654435761 % 4294967296) < 0.85 * 4294967296"


def _knn_sql(distance, vote):
    return f"""
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, {_TRAIN} AS is_train FROM embeddings),
near AS (SELECT q.vec_id AS query_id, t.label, {distance} AS dist,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY {distance}, t.vec_id) AS rn
  FROM v q JOIN v t ON NOT q.is_train AND t.is_train),
votes AS (SELECT query_id, label, {vote} AS w FROM near WHERE rn <= 15 GROUP BY ALL)
SELECT query_id, label AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(w, 9) DESC, label) AS rn FROM votes) WHERE rn = 1"""


def _vectors(spark, d):
    vectors = views.table(spark, d, "embeddings").select("vec_id", "embedding", "label")
    is_train = F.expr("pmod(vec_id * 2654435761, 4294967296) < 0.85 * 4294967296")
    return vectors.filter(is_train), vectors.filter(~is_train)


@query("knn_vote", _knn_sql("sqrt(list_sum(list_transform(list_zip(q.e, t.e), lambda x: (x[1] - x[2]) * (x[1] - x[2]))))", "count(*)"))
def knn_vote(spark, d):
    train, queries = _vectors(spark, d)
    return neighbors.classify(train, queries, "vec_id", "embedding", "label", k=15)


@query("knn_distance_weighted", _knn_sql("list_sum(list_transform(list_zip(q.e, t.e), lambda x: abs(x[1] - x[2])))", "sum(1 / greatest(dist, 1e-12))"))
def knn_distance_weighted(spark, d):
    train, queries = _vectors(spark, d)
    return neighbors.classify(train, queries, "vec_id", "embedding", "label", k=15, p=1, weights="distance")
