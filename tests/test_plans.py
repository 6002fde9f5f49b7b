"""Steps whose cost must not grow faster than their input: what their plans hold."""

import datetime as dt

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from legwork.operators import clean, graph, weather
from legwork.plans import training, tuning
from legwork.sources import views

NOON = dt.datetime(2024, 1, 1, 12)


def events(spark, tmp_path):
    rows = [(i, NOON, i % 5, "x", 40.0 + i, '{"k": %d}' % (i % 9)) for i in range(400)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_legs_read_the_text_of_an_event_once(spark, tmp_path):
    """A filter on the arrival time was moved to the scan, where it read the text in every term."""
    kept = clean.drop_lost_legs(views.raw_legs(spark, events(spark, tmp_path)))
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") == 1


def test_legs_of_one_file_are_dealt_to_all_cores(spark, tmp_path):
    found = views.raw_legs(spark, events(spark, tmp_path))
    assert found.count() == 400
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def unmatched(spark):
    schema = "FlightID long, Origin string, Dest string, floor_informationtime_UTC timestamp_ntz"
    later = NOON + dt.timedelta(hours=1)
    rows = [
        (1, "A", "B", NOON), (2, "A", "C", NOON), (3, "C", "A", NOON), (4, "A", "B", later), (4, "A", "B", later),
        (5, None, "A", NOON), (6, "A", "B", None),
    ]
    hours = spark.createDataFrame([("A", NOON), ("B", NOON), ("B", NOON)], "airport string, timestamp timestamp_ntz")
    readings = hours.withColumns({c: F.lit(1.0) for c in ("temp", "prcp", "wspd", "rhum")})
    return weather.unmatched_legs(spark.createDataFrame(rows, schema), readings)


def test_unmatched_legs(spark):
    assert sorted(r["FlightID"] for r in unmatched(spark).collect()) == [2, 3, 4, 5, 6]


def test_unmatched_legs_are_not_shuffled_for_the_weather(spark):
    plan = unmatched(spark)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_links_of_a_graph_are_held_by_the_key_of_their_join(spark):
    """Every round of PageRank and of the core numbers shuffled all links."""
    pairs = spark.range(200).selectExpr("id % 10 AS a", "id + 10 AS b")
    links = graph._held(graph.both_ways(pairs), "src")
    links.count()
    nodes = spark.range(210).withColumnRenamed("id", "src").withColumn("v", F.lit(1))
    plan = links.join(nodes.hint("shuffle_merge"), "src")
    plan.count()
    shown = plan._jdf.queryExecution().executedPlan().toString()
    links.unpersist()
    before = shown[: shown.index("InMemoryTableScan")]
    assert "InMemoryTableScan" in shown and "Exchange" not in before.split("SortMergeJoin")[-1]


def test_fold_rows_lie_in_no_more_parts_than_cores(spark, monkeypatch):
    """Every step of every fit sends the results of all tasks to the driver."""
    rows = [(i, "train", float(i % 4), Vectors.dense(float(i % 7), float(i % 4)), 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, ["FlightID", "split", "label", "features", "weight"]).repartition(40)
    times = spark.range(400).selectExpr("id AS FlightID", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, id) AS t")
    seen = []
    known = tuning._weighted

    def weighted(part, weights):
        seen.append(part.rdd.getNumPartitions())
        return known(part, weights)

    monkeypatch.setattr(tuning, "_weighted", weighted)
    prepared = training.Prepared(df, ["a", "b"], None, None)
    found = tuning.random_search(prepared, "naive_bayes", times, "t", "FlightID", n_iter=2, folds=2)
    assert found.count() == 2
    assert len(seen) == 4 and max(seen) <= spark.sparkContext.defaultParallelism < df.rdd.getNumPartitions()
