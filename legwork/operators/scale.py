"""Scalers fitted on one table and applied to others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_scaler(train: DataFrame, columns: Sequence[str], kind: str = "minmax", with_mean: bool = True) -> DataFrame:
    """One row per column with what to subtract and what to divide by.

    A constant column divides by 1, so it becomes 0. ``standard`` uses the population
    deviation.
    """
    if kind not in ("minmax", "standard"):
        raise ValueError(f"Invalid scale value: {kind}. Use 'minmax' or 'standard'.")
    entries = []
    for c in columns:
        x = F.col(c).cast("double")
        if kind == "minmax":
            center, width = F.min(x), F.max(x) - F.min(x)
        else:
            center, width = (F.avg(x) if with_mean else F.lit(0.0)), F.stddev_pop(x)
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                center.alias("center"),
                F.when(width == 0, F.lit(1.0)).otherwise(width).alias("width"),
            )
        )
    return train.agg(F.array(*entries).alias("p")).select(F.inline("p"))


def apply_scaler(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - center) / width; the fitted numbers (one row per column) become literals."""
    fitted = {row["column"]: row for row in params.filter(F.col("column").isin(list(columns))).collect()}
    return df.withColumns(
        {c: (F.col(c).cast("double") - fitted[c]["center"]) / fitted[c]["width"] for c in columns}
    )
