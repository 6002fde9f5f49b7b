"""Writers: partitioned Parquet, CSV, per-month copies, JSON records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Overwrites ``path``; partition columns become folders."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def write_legs(legs: DataFrame, path: str, gathered: bool = False) -> str:
    """Cleaned legs or features, one folder per year and month.

    Rows are first gathered by folder; Spark divides large folders and joins small ones, so
    tasks do not write a file into every folder. Legs whose parts follow their time are
    ``gathered`` already.
    """
    return write_parquet(legs if gathered else legs.hint("rebalance", "Year", "Month"), path, ["Year", "Month"])


def read_legs(spark: SparkSession, path: str) -> DataFrame:
    """Reads what ``write_legs`` wrote, with year and month as they were."""
    legs = spark.read.parquet(path)
    return legs.withColumns({c: F.col(c).cast("bigint") for c in ("Year", "Month")})


def copy_raw_months(raw: DataFrame, root: str) -> str:
    """Raw records as CSV, one folder per month below ``root``, without an index column."""
    (
        raw.write.mode("overwrite")
        .partitionBy("Year", "Month")
        .option("header", True)
        .csv(f"{root}/data/raw")
    )
    return f"{root}/data/raw"


def append_metrics(metrics: DataFrame, path: str) -> str:
    """Adds rows to a long table of metrics or settings."""
    metrics.write.mode("append").parquet(path)
    return path
