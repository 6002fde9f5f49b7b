"""The daily stream over several batches."""

from datetime import datetime

from legwork.streaming import jobs


def test_update_keeps_the_latest_count(spark, tmp_path):
    folder = str(tmp_path / "log")
    days = [["2024-01-01", "2024-01-01", "2024-01-02"], ["2024-01-01", "2024-01-02", "2024-01-03"], ["2024-01-03"]]
    for batch in days:
        rows = [(datetime.fromisoformat(f"{d}T10:00:00"),) for d in batch]
        spark.createDataFrame(rows, "ts timestamp").coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", 1).parquet(folder)
    found = jobs.run_update(jobs.daily_counts(stream, "10 days"), "days", "day")
    counts = {r["day"].day: r["num_messages"] for r in found.collect()}
    assert counts == {1: 3, 2: 2, 3: 2} and found.columns == ["day", "num_messages"]


def test_no_file_yet(spark, tmp_path):
    folder = tmp_path / "empty"
    folder.mkdir()
    stream = spark.readStream.schema("ts timestamp").parquet(str(folder))
    assert jobs.run_update(jobs.daily_counts(stream), "none", "day").count() == 0
