"""Place of an indicator and the even spread of prepared rows, on rows made here."""

import warnings

import numpy as np
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwork import session
from legwork.operators import encode
from legwork.plans import boosting, models, training


def test_place_is_read_without_a_dense_vector(spark):
    size = 500_000_000  # as an array of numbers: 4 GB a row
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", VectorUDT())])
    rows = [(1, SparseVector(size, {size - 1: 1.0})), (2, SparseVector(size, {0: 1.0})), (3, SparseVector(size, {})), (4, None)]
    found = spark.createDataFrame(rows, schema).select("id", encode.place_of("v").alias("place")).collect()
    assert dict(map(tuple, found)) == {1: size - 1, 2: 0, 3: None, 4: None}


def test_prepared_rows_lie_in_even_parts(spark, monkeypatch):
    monkeypatch.setattr(session, "LEAST_ROWS", 50)
    one_file = spark.range(1000).coalesce(1).withColumns({
        "FlightID": F.col("id"), "CRSDepDateTime_UTC": F.timestamp_seconds(F.col("id")).cast("timestamp_ntz"),
        "ArrDelayMinutes": (F.col("id") % 300).cast("double"), "Distance": F.col("id").cast("double"),
        "Origin": F.concat(F.lit("A"), (F.col("id") % 3).cast("string")),
    }).drop("id")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        prepared = training.prepare(one_file, training.TrainingConfig())
    sizes = [r["n"] for r in prepared.rows.filter("split = 'train'").groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 700 and len(sizes) >= 8 and max(sizes) < 3 * 700 / len(sizes)
    assert prepared.rows.filter("weight IS NULL").isEmpty() and prepared.names[:1] == ["Distance"]


def test_parts_are_few_unless_rows_are_very_many(spark):
    cores = spark.sparkContext.defaultParallelism
    frame = spark.range(1)
    assert [session.even_parts(frame, n) for n in (0, 1, 2048, 2049)] == [1, 1, 1, 2]
    assert session.even_parts(frame, 1_000_000) == 2 * cores and session.even_parts(frame, 1 << 28) == max(2 * cores, 1024)


def test_boosted_blocks_use_all_cores(spark, monkeypatch):
    monkeypatch.setattr(boosting, "TASK_ROWS", 50)
    parts = []
    rounds = boosting.HistogramBoosting._rounds
    monkeypatch.setattr(boosting.HistogramBoosting, "_rounds", lambda self, blocks, n, *more: parts.append(n) or rounds(self, blocks, n, *more))
    rows = spark.range(400).selectExpr("array(double(id % 7), double(id % 5)) AS x", "double(id % 2) AS label")
    rows = rows.select(array_to_vector("x").alias("features"), "label")
    assert models.make_model("xgboost", maxIter=1, maxDepth=2).fit(rows).n_rounds == 1
    assert parts == [min(8, spark.sparkContext.defaultParallelism)]


def test_one_versus_rest_holds_no_second_copy(spark):
    rows = spark.range(60).selectExpr("array(double(id % 3), double(id % 5)) AS x", "double(id % 3) AS label", "1D AS weight")
    rows = rows.select(array_to_vector("x").alias("scaled"), "label", "weight")
    held = []

    class Watching(LinearSVC):
        def _fit(self, dataset):
            held.append("InMemoryRelation" in dataset._jdf.queryExecution().withCachedData().toString())
            return super()._fit(dataset)

    settings = {"featuresCol": "scaled", "labelCol": "label", "weightCol": "weight"}
    ours = models.OneVersusRest(classifier=Watching(maxIter=20), **settings).fit(rows)
    assert held == [False] * 3
    plain = OneVsRest(classifier=LinearSVC(maxIter=20), **settings).fit(rows)
    for a, b in zip(ours.models, plain.models):
        np.testing.assert_allclose(a.coefficients.toArray(), b.coefficients.toArray(), atol=1e-9)
    assert ours.transform(rows).select("prediction").collect() == plain.transform(rows).select("prediction").collect()


def test_small_dictionaries_leave_the_rows_where_they_are(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(100)], "id int, k string").repartition(7)
        dictionary = spark.createDataFrame([("k", "a", 0), ("k", "b", 1)], "column string, value string, index int")
        coded, _ = encode.one_hot_vectors(rows, dictionary, ["k"])
        parts = coded.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()
        assert len(parts) == 7 and sum(r["n"] for r in parts) == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
