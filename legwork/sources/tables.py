"""Readers: by suffix, by month, headerless text, optional files, roots."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.schemas import EDGE_SCHEMA, MESSAGE_SCHEMA, NODE_SCHEMA, NON_NULL_LEG_COLUMNS, RAW_LEG_TYPES

# --- Fixed values: name of a monthly file of the on-time source --------------------------
MONTH_FILE = "On_Time_Reporting_Carrier_On_Time_Performance_(1987_present)_{year}_{month}.csv"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def join_path(root: str, *parts: str) -> str:
    """Appends relative parts to a local or object-store root."""
    if not root:
        raise ValueError("The root folder is empty")
    clean = [str(p).strip("/") for p in parts if str(p)]
    return "/".join([root.rstrip("/") or "/", *clean])


def configure_object_store(spark: SparkSession, root: str) -> str:
    """Credentials for an ``s3://`` root from the environment; returns the ``s3a://`` root.

    Other roots are returned as they are.
    """
    if not root:
        raise ValueError("The root folder is empty")
    if not root.startswith("s3://"):
        return root
    needed = {"AWS_ACCESS_KEY_ID": "fs.s3a.access.key", "AWS_SECRET_ACCESS_KEY": "fs.s3a.secret.key"}
    absent = sorted(name for name in needed if not os.environ.get(name))
    if absent:
        raise KeyError(f"Missing object-store environment variables: {', '.join(absent)}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name, key in needed.items():
        conf.set(key, os.environ[name])
    endpoint = os.environ.get("S3_ENDPOINT_URL")
    if endpoint:
        conf.set("fs.s3a.endpoint", endpoint)
        conf.set("fs.s3a.path.style.access", "true")
    return "s3a://" + root.removeprefix("s3://").rstrip("/")


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Reader by suffix: ``.parquet``, ``.csv`` or ``.tsv``; anything else raises."""
    suffix = os.path.splitext(path.rstrip("/"))[1]
    if suffix == ".parquet":
        return spark.read.parquet(path)
    if suffix in (".csv", ".tsv"):
        reader = spark.read.option("header", True).option("sep", "," if suffix == ".csv" else "\t")
        reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
        return reader.csv(path)
    raise ValueError(f"Unsupported file type: {suffix or path}")


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None when the path does not exist."""
    return read_table(spark, path) if path_exists(spark, path) else None


def typed_legs(texts: DataFrame, *more: Column) -> DataFrame:
    """The 30 leg columns of text rows, typed; a null in an integer column fails.

    The check is a filter: unlike a column it is evaluated whatever the caller reads.
    """
    legs = texts.select(*[F.col(n).cast(kind).alias(n) for n, kind in RAW_LEG_TYPES.items()], *more)
    whole = F.lit(True)
    for name in NON_NULL_LEG_COLUMNS:
        bad = F.raise_error(F.lit(f"Column {name} holds a null")).cast("boolean")
        whole = F.when(F.col(name).isNull(), bad).otherwise(whole)
    return legs.filter(whole)


def read_raw_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The leg columns of raw CSV files."""
    return typed_legs(spark.read.option("header", True).csv(list(paths)))


def month_paths(root: str, years: Sequence[int], months: Sequence[int] = tuple(range(1, 13))) -> list[str]:
    return [join_path(root, MONTH_FILE.format(year=y, month=m)) for y in years for m in months]


def read_months(
    spark: SparkSession, root: str, years: Sequence[int], months: Sequence[int] = tuple(range(1, 13))
) -> DataFrame:
    """All present monthly files as one table with its file name; none gives an empty table."""
    present = [p for p in month_paths(root, years, months) if path_exists(spark, p)]
    if not present:
        kinds = ", ".join(f"`{n}` {k}" for n, k in RAW_LEG_TYPES.items())
        return spark.createDataFrame([], f"{kinds}, source_file string")
    # parentheses in the file names are no glob pattern, so the names can be passed as they are
    texts = spark.read.option("header", True).csv(present)
    return typed_legs(texts, F.col("_metadata.file_name").alias("source_file"))


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Headerless, space-separated sender, receiver and epoch second."""
    return spark.read.schema(MESSAGE_SCHEMA).option("sep", " ").csv(path)


def _by_name(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV columns found by their names in the header, whatever their order; absent ones are null."""
    kinds = [c.strip().split() for c in schema.split(",")]
    rows = spark.read.option("header", True).csv(path)
    found = {name: F.col(f"`{name}`") if name in rows.columns else F.lit(None) for name, _ in kinds}
    return rows.select([found[name].try_cast(kind).alias(name) for name, kind in kinds])


def read_graph(spark: SparkSession, edges_path: str, nodes_path: str) -> tuple[DataFrame, DataFrame]:
    """Edge and node CSV files under their documented columns; a value of another kind is null."""
    return _by_name(spark, edges_path, EDGE_SCHEMA), _by_name(spark, nodes_path, NODE_SCHEMA)


def preview(df: DataFrame, rows: int = 1000) -> DataFrame:
    """The first rows, as a look at the data."""
    return df.limit(rows)
