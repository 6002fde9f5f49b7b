"""Run records: discovery and flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.sources.tables import path_exists

METRIC_SPLITS = ("train", "validation", "test")


def read_runs(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """All ``runs/*/run_info.json`` records below the roots, with their folder; none raises."""
    present = [f"{r}/runs" for r in roots if path_exists(spark, f"{r}/runs")]
    if not present:
        raise FileNotFoundError("No run_info.json files found. Check the roots or run training first.")
    records = spark.read.option("multiLine", True).json([f"{p}/*/run_info.json" for p in present])
    path = F.col("_metadata.file_path")
    return records.select(
        "*", path.alias("run_info_path"), F.regexp_replace(path, r"/run_info\.json(/[^/]*)?$", "").alias("run_dir")
    )


def flatten_runs(records: DataFrame) -> DataFrame:
    """One row per run with its settings; a field that is absent becomes null."""
    return records.select(
        "run_id",
        F.try_to_timestamp("created_at_utc").alias("created_at_utc"),
        "run_dir",
        F.col("model.name").alias("model_name"),
        F.col("model.class_name").alias("model_class"),
        F.coalesce("tuning.enabled", F.lit(False)).alias("tuned"),
        F.col("tuning.scoring").alias("scoring"),
        F.col("tuning.n_iter").alias("n_iter"),
        F.col("tuning.cv_splits").alias("cv_splits"),
        F.col("tuning.best_score").alias("best_cv_score"),
        *[F.col(f"splits.{s}_rows").alias(f"{s}_rows") for s in METRIC_SPLITS],
        F.col("features.count").alias("feature_count"),
    )


def run_metrics(records: DataFrame) -> DataFrame:
    """(run_id, model_name, split, metric, value) of every recorded metric."""
    kind = "map<string,double>"
    entries = F.array(
        *[
            F.struct(
                F.lit(s).alias("split"),
                F.from_json(F.to_json(F.col(f"metrics.{s}")), kind).alias("values"),
            )
            for s in METRIC_SPLITS
        ]
    )
    long = records.select("run_id", F.col("model.name").alias("model_name"), F.inline(entries))
    return long.select("run_id", "model_name", "split", F.explode("values").alias("metric", "value"))
