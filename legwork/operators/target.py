"""Delay-class target, class shares and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwork.functions.scalars import class_ordinal, delay_class
from legwork.schemas import DELAY_CLASSES, DELAY_COLUMN, FIXED_CLASS_WEIGHTS, TARGET_COLUMN


def add_delay_class(
    legs: DataFrame, delay_column: str = DELAY_COLUMN, target_column: str = TARGET_COLUMN
) -> DataFrame:
    """Adds the ordered class; rows without a delay value are removed."""
    if delay_column not in legs.columns:
        raise ValueError(f"There is no column {delay_column} to classify")
    labelled = legs.withColumn(target_column, delay_class(F.col(delay_column)))
    return labelled.filter(F.col(target_column).isNotNull())


def encode_label(df: DataFrame, target_column: str = TARGET_COLUMN, label: str = "label") -> DataFrame:
    """Class text -> ordinal; an unknown class fails the job."""
    known = class_ordinal(F.col(target_column))
    text = F.concat(F.lit("Unknown target label: "), F.col(target_column))
    return df.withColumn(label, F.coalesce(known, F.raise_error(text).cast("int")).cast("double"))


def labels_frame(spark, labels=DELAY_CLASSES, name: str = TARGET_COLUMN) -> DataFrame:
    """The fixed class order as rows."""
    pairs = F.array(*[F.struct(F.lit(v).alias(name), F.lit(i).alias("ordinal")) for i, v in enumerate(labels)])
    return spark.range(1).select(F.inline(pairs))


def class_balance(
    df: DataFrame, target_column: str = TARGET_COLUMN, test_share: float = 0.15
) -> DataFrame:
    """Rows and share of every class in fixed order; an absent class counts 0."""
    counted = df.groupBy(target_column).agg(F.count(F.lit(1)).alias("rows"))
    total = counted.agg(F.sum("rows")).scalar()
    return (
        labels_frame(df.sparkSession, name=target_column)
        .join(counted, target_column, "left")
        .withColumn("rows", F.coalesce("rows", F.lit(0)))
        .select(
            target_column,
            "ordinal",
            "rows",
            F.round(F.col("rows") / total, 6).alias("share"),
            F.round(F.col("rows") * test_share, 6).alias("expected_in_test"),
        )
    )


def class_weights(df: DataFrame, label: str = "label", weights: object = "balanced") -> DataFrame:
    """One row per class with its weight.

    ``balanced`` gives n / (k * n_c), a dict is used as it is, None means the fixed set.
    """
    if isinstance(weights, str):
        if weights != "balanced":
            raise ValueError("Class weights are a mapping, 'balanced' or absent")
        counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
        overall = counted.agg(
            F.struct(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("k"))
        ).scalar()
        return counted.select(
            label, "rows", (overall["n"] / (overall["k"] * F.col("rows"))).alias("weight")
        )
    if weights is None:
        weights = FIXED_CLASS_WEIGHTS
    if not isinstance(weights, dict):
        raise ValueError("Class weights are a mapping, 'balanced' or absent")
    pairs = F.array(
        *[F.struct(F.lit(float(c)).alias(label), F.lit(float(w)).alias("weight")) for c, w in weights.items()]
    )
    given = df.sparkSession.range(1).select(F.inline(pairs))
    counted = df.groupBy(F.col(label).cast("double").alias(label)).agg(F.count(F.lit(1)).alias("rows"))
    return given.join(counted, label, "left").select(
        label, F.coalesce("rows", F.lit(0)).alias("rows"), "weight"
    )


def add_row_weight(
    df: DataFrame, weights: DataFrame, label: str = "label", name: str = "weight"
) -> DataFrame:
    """Attaches the class weight to every row (the weight table has one row per class)."""
    table = weights.select(F.col(label), F.col("weight").alias(name))
    return df.join(F.broadcast(table), label, "left")
