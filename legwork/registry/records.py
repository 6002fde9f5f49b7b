"""Run records and the metric log of a training run."""

from pyspark.sql import functions as F

from legwork.plans import training
from legwork.registry.base import query
from legwork.registry.feature_rows import feature_rows
from legwork.session import scratch_path
from legwork.sources import runs


def _trained(spark, d):
    output = scratch_path(spark, "output")
    rows = feature_rows(spark, d)
    training.run_training(rows, training.TrainingConfig(model_name="naive_bayes"), output)
    return output


@query("run_record_roundtrip")
def run_record_roundtrip(spark, d):
    records = runs.read_runs(spark, [_trained(spark, d)])
    flat = runs.flatten_runs(records).select(
        "model_name", "tuned", "train_rows", "validation_rows", "test_rows", "feature_count")
    return flat.join(runs.run_metrics(records).drop("run_id"), "model_name")


@query("metric_log")
def metric_log(spark, d):
    stored = spark.read.parquet(f"{_trained(spark, d)}/metrics")
    return stored.select("model_name", "split", "metric", F.round("value", 6).alias("value"))
