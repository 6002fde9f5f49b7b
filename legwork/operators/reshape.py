"""Long and wide tables, best rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide -> long."""
    return df.unpivot(list(ids), list(columns), name, value)


def widen(df: DataFrame, ids: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long -> wide for a known list of names, in one aggregation."""
    return df.groupBy(*ids).pivot(name, list(names)).agg(F.first(value, ignorenulls=True))


def best_rows(df: DataFrame, group: str, score: str, tie: str) -> DataFrame:
    """The whole row with the best score per group; missing scores last, ties by ``tie``."""
    rest = [c for c in df.columns if c != group]
    worst = -F.coalesce(F.col(score), F.lit(float("-inf")))
    best = F.min_by(F.struct(*rest), F.struct(worst, F.col(tie)))
    return df.groupBy(group).agg(best.alias("_r")).select(group, "_r.*")


def first_known(df: DataFrame, group: str, score: str, tie: str) -> DataFrame:
    """Per column the first non-missing value of the group in score order."""
    rest = [c for c in df.columns if c != group]
    worst = -F.coalesce(F.col(score), F.lit(float("-inf")))
    return df.groupBy(group).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(worst, F.col(tie)))).alias(c) for c in rest]
    )
