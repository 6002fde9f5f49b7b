"""Readers, writers, models: guards and round trips."""

import io
import os
import random
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from legwork import schemas
from legwork.functions.scalars import hash32
from legwork.operators import clean, split
from legwork.plans import models, training, tuning
from legwork.sources import archive, runs, sinks, tables


def test_guards(spark, tmp_path, monkeypatch):
    with pytest.raises(ValueError):
        tables.read_table(spark, "x.xlsx")
    with pytest.raises(ValueError):
        tables.join_path("")
    assert tables.join_path("s3a://b/", "/a/", "c.csv") == "s3a://b/a/c.csv"
    monkeypatch.delenv("AWS_ACCESS_KEY_ID", raising=False)
    with pytest.raises(KeyError):
        tables.configure_object_store(spark, "s3://bucket")
    assert tables.read_optional(spark, str(tmp_path / "absent.csv")) is None
    with pytest.raises(FileNotFoundError):
        runs.read_runs(spark, [str(tmp_path)])
    with pytest.raises(ValueError):
        models.make_model("oracle")
    empty = tables.read_months(spark, str(tmp_path), [2014])
    assert empty.count() == 0 and set(schemas.RAW_LEG_TYPES) <= set(empty.columns)


def test_archives(spark, tmp_path):
    header = ",".join([*schemas.RAW_LEG_TYPES, "Extra"])
    for month in (1, 2):
        values = {n: "1" for n in schemas.RAW_LEG_TYPES} | {"FlightDate": f"2014-0{month}-01", "Tail_Number": "", "Month": str(month)}
        body = ",".join([*values.values(), "z"])
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            z.writestr("legs.csv", f"{header}\n{body}\n{body}\n")
            z.writestr("readme.html", "no table")
        (tmp_path / f"m{month}.zip").write_bytes(packed.getvalue())
    found = archive.read_archives(spark, str(tmp_path))
    assert found.count() == 4 and found.filter("Tail_Number IS NULL").count() == 4
    loaded = spark.createDataFrame([("m1.zip",)], "archive string")
    assert {r["Month"] for r in archive.read_archives(spark, str(tmp_path), loaded).collect()} == {2}


def test_written_archives_read_back_member_by_member(spark, tmp_path):
    names = list(schemas.RAW_LEG_TYPES)
    kinds = ", ".join(f"`{n}` {k}" for n, k in schemas.RAW_LEG_TYPES.items())
    base = spark.createDataFrame([], kinds)
    rows = spark.range(700).select(
        F.lit(2024).alias("Year"), (F.col("id") % 3 + 1).alias("Month"), F.col("id").alias("CRSDepTime"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit('a,"b"\n'), F.col("id").cast("string"))).alias("Tail_Number"))
    legs = base.unionByName(rows.select(*[F.col(n).cast(schemas.RAW_LEG_TYPES[n]).alias(n) for n in rows.columns]), allowMissingColumns=True)
    written = archive.write_archives(legs, str(tmp_path / "zips"), member_rows=50)
    assert written.agg(F.sum("rows")).first()[0] == 700
    found = archive.read_archives(spark, str(tmp_path / "zips"))
    assert found.rdd.getNumPartitions() == written.agg(F.sum("members")).first()[0] > 12
    assert found.select(*names).exceptAll(legs.select(*names)).count() == 0 and found.count() == 700
    assert archive.read_archives(spark, str(tmp_path / "zips"), written).count() == 0
    nothing = archive.write_archives(base, str(tmp_path / "none"))
    assert nothing.count() == 0


def test_graph_files_are_read_by_name(spark, tmp_path):
    sinks.write_csv(spark.sql("SELECT 7 AS target_id, 1 AS src_id"), str(tmp_path / "e"))
    names = [c.split()[0] for c in schemas.NODE_SCHEMA.split(",")]
    nodes = spark.sql("SELECT " + ", ".join(f"'x{i}' AS {n}" if n == "language" else f"{i} AS {n}" for i, n in enumerate(reversed(names))))
    sinks.write_csv(nodes, str(tmp_path / "n"))
    edges, found = tables.read_graph(spark, str(tmp_path / "e"), str(tmp_path / "n"))
    assert [tuple(r) for r in edges.collect()] == [(1, 7)]
    row = found.first().asDict()
    assert {n: str(row[n]).lstrip("x") for n in names if n not in ("creation_date", "last_stream")} == {
        n: str(i) for i, n in enumerate(reversed(names)) if n not in ("creation_date", "last_stream")}


def test_sample_of_n_by_the_row_at_its_place(spark):
    ids = [(i,) for i in range(500)] + [(None,), (None,)]
    df = spark.createDataFrame(ids, "id long")
    order = [r["id"] for r in df.filter("id IS NOT NULL").orderBy(hash32(F.col("id")), "id").collect()]
    for n in (0, 1, 137, 499, 500, 501, 502, 900):
        found = [r["id"] for r in split.hash_sample_n(df, "id", n).collect()]
        assert len(found) == min(n, 502) and set(order[:n]) <= set(found)


def test_null_in_integer_column_fails(spark, tmp_path):
    names = list(schemas.RAW_LEG_TYPES)
    (tmp_path / "x.csv").write_text(",".join(names) + "\n" + "," * (len(names) - 1) + "\n")
    with pytest.raises(Exception, match="holds a null"):
        tables.read_raw_csv(spark, [str(tmp_path / "x.csv")]).collect()


def test_draws_are_seeded():
    a = tuning.draw_candidates("logistic_regression", 5)
    assert a == tuning.draw_candidates("logistic_regression", 5)
    assert all(1e-3 <= c["settings"]["C"] <= 10 for c in a)
    low, high = tuning.CLASS_WEIGHT_RANGES[3]
    assert all(low <= c["weights"][3] <= high for c in a)


def test_tuned_run_is_recorded(spark, tmp_path):
    draw = random.Random(1)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(240):
        distance = float(draw.randrange(4))
        delay = [0.0, 30.0, 100.0, 300.0][int(distance)]
        rows.append((i, start + timedelta(hours=i), delay, distance, "AB"[i % 2]))
    table = spark.createDataFrame(
        rows, "FlightID bigint, CRSDepDateTime_UTC timestamp_ntz, ArrDelayMinutes double, Distance double, Origin string")
    config = training.TrainingConfig(model_name="decision_tree", tune=True, n_iter=2, cv_splits=2)
    with pytest.warns(UserWarning, match="no column"):
        metrics = training.run_training(table, config, str(tmp_path))
    accuracy = {r["split"]: r["value"] for r in metrics.filter("metric = 'accuracy'").collect()}
    assert accuracy["test"] == 1.0
    record = runs.read_runs(spark, [str(tmp_path)]).first()
    assert record["tuning"]["enabled"] and record["tuning"]["n_iter"] == 2 and record["tuning"]["best_score"] > 0.5
    assert len(record["artifacts"]["tuned_models"]) == 2
    assert all(os.path.isdir(p) for p in [record["artifacts"]["model"], *record["artifacts"]["tuned_models"]])
    stored = spark.read.parquet(f"{record['run_dir'].removeprefix('file:')}/tuned_models/tuning_class_weights")
    assert stored.count() == 8
    logged = {r["name"]: r["value"] for r in spark.read.parquet(str(tmp_path / "params")).collect()}
    assert logged["n_iter"] == "2" and logged["model_name"] == "decision_tree"


def test_flight_ids_follow_the_order_of_the_records(spark):
    names = [n for n in schemas.RAW_LEG_TYPES]
    days = ["2024-01-02", "2024-01-01", "2024-01-01", None]
    raw = spark.createDataFrame([(d, 900 + i, "X") for i, d in enumerate(days)], "FlightDate string, CRSDepTime bigint, Reporting_Airline string")
    raw = raw.select("*", *[F.lit(None).cast(schemas.RAW_LEG_TYPES[n]).alias(n) for n in names if n not in raw.columns])
    found = {r["CRSDepTime"]: r["FlightID"] for r in clean.add_flight_id(raw.repartition(3)).collect()}
    assert found == {903: 0, 901: 1, 902: 2, 900: 3}
