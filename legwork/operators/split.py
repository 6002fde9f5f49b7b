"""Chronological, threshold, stratified and fold splits, and samples.

A split only looks for the rows at its cut positions; every other row is labelled by
comparing its order values with the cuts, without a sort or a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwork.functions.scalars import hash32
from legwork.operators.ranking import cut_rows
from legwork.session import cut_lineage


def _time_levels(time_column: str, id_column: str) -> list[Column]:
    return [F.date_trunc("HOUR", time_column), F.col(time_column), F.floor(F.col(id_column) / 65536)]


def _time_cuts(df: DataFrame, time_column: str, id_column: str, targets: dict[str, Column]) -> dict[str, Column]:
    """(time, id) at every target position, as literals: one row per target is fetched.

    A position past the last row has no literal and compares as later than every row.
    """
    order = [time_column, id_column]
    cuts = cut_rows(df.select(*order), [], _time_levels(time_column, id_column), order, targets)
    found = {row["cut"]: row for row in cuts.collect()}
    kinds = [df.schema[c].dataType for c in order]
    return {
        t: F.struct(*[F.lit(found[t][c]).cast(k).alias(c) for c, k in zip(order, kinds)])
        for t in targets
        if t in found
    }


def _before(df: DataFrame, time_column: str, id_column: str, cut: Column | None) -> Column:
    if cut is None:
        return F.lit(True)
    # the plain comparison on time can reach the scan, the id decides within one moment
    time, row_id = F.col(time_column), F.col(id_column)
    return (time < cut[time_column]) | ((time == cut[time_column]) & (row_id < cut[id_column]))


def check_shares(train_size: float, val_size: float) -> None:
    shares = (train_size, val_size, 1 - train_size - val_size)
    if min(shares) <= 0:
        raise ValueError(f"Every split needs a share of the rows, not {shares}")


def chronological_split(
    df: DataFrame,
    time_column: str,
    id_column: str,
    train_size: float = 0.7,
    val_size: float = 0.15,
    name: str = "split",
) -> DataFrame:
    """Labels rows train, validation or test by their place in time order."""
    if time_column not in df.columns:
        raise ValueError(f"There is no column {time_column} to order rows by")
    check_shares(train_size, val_size)
    n = F.col("n")
    cuts = _time_cuts(
        df,
        time_column,
        id_column,
        {"validation": F.floor(n * F.lit(train_size)), "test": F.floor(n * F.lit(train_size + val_size))},
    )
    def before(cut: str) -> Column:
        return _before(df, time_column, id_column, cuts.get(cut))

    return df.withColumn(
        name, F.when(before("validation"), "train").when(before("test"), "validation").otherwise("test")
    )


def threshold_split(df: DataFrame, time_column: str, threshold: str, name: str = "split") -> DataFrame:
    """Labels rows before the threshold train, the rest test; the threshold must occur."""
    if time_column not in df.columns:
        raise ValueError(f"There is no column {time_column} to order rows by")
    at = F.lit(threshold).cast(df.schema[time_column].dataType)
    if df.filter(F.col(time_column) == at).isEmpty():
        raise ValueError(f"No row of {time_column} is at {threshold}")
    return df.withColumn(name, F.when(F.col(time_column) < at, "train").otherwise("test"))


def time_folds(df: DataFrame, time_column: str, id_column: str, folds: int, name: str = "block") -> DataFrame:
    """Block of each row for expanding folds: fold i tests block i and trains on all before."""
    size = F.floor(F.col("n") / (folds + 1))
    starts = {f"b{i}": F.col("n") - size * (folds - i + 1) for i in range(1, folds + 1)}
    cuts = _time_cuts(df, time_column, id_column, starts)
    block = F.lit(folds)
    for i in range(folds, 0, -1):
        block = F.when(_before(df, time_column, id_column, cuts.get(f"b{i}")), F.lit(i - 1)).otherwise(block)
    return df.withColumn(name, block)


def _class_cuts(df: DataFrame, label: str, id_column: str, targets: dict[str, Column]) -> DataFrame:
    """Per class the (hash, id) at the target positions; one row per class."""
    hashed = df.select(label, hash32(F.col(id_column)).alias("_h"), F.col(id_column).alias("_id"))
    levels = [F.floor(F.col("_h") / 1048576), F.col("_h")]
    cuts = cut_lineage(cut_rows(hashed, [label], levels, ["_h", "_id"], targets))
    return cuts.groupBy(label).agg(
        *[F.max(F.when(F.col("cut") == t, F.struct("_h", "_id"))).alias(f"_cut_{t}") for t in targets]
    )


def stratified_split(
    df: DataFrame,
    label: str,
    id_column: str,
    train_size: float = 0.7,
    val_size: float = 0.15,
    name: str = "split",
) -> DataFrame:
    """Random split that keeps the class shares; the draw is a hash of the id."""
    check_shares(train_size, val_size)
    n = F.col("n")
    cuts = _class_cuts(
        df,
        label,
        id_column,
        {"validation": F.floor(n * F.lit(train_size)), "test": F.floor(n * F.lit(train_size + val_size))},
    )
    here = F.struct(hash32(F.col(id_column)).alias("_h"), F.col(id_column).alias("_id"))
    # one row per class, a handful of classes
    return (
        df.join(F.broadcast(cuts), label)
        .withColumn(
            name,
            F.when(here < F.col("_cut_validation"), "train")
            .when(here < F.col("_cut_test"), "validation")
            .otherwise("test"),
        )
        .drop("_cut_validation", "_cut_test")
    )


def stratified_folds(df: DataFrame, label: str, id_column: str, folds: int, name: str = "fold") -> DataFrame:
    """Fold number with equal class shares per fold, drawn by a hash of the id."""
    targets = {f"f{i}": F.ceil(F.col("n") * i / folds) for i in range(1, folds)}
    cuts = _class_cuts(df, label, id_column, targets)
    here = F.struct(hash32(F.col(id_column)).alias("_h"), F.col(id_column).alias("_id"))
    fold = F.lit(0)
    for i in range(1, folds):
        fold = F.when(here >= F.col(f"_cut_f{i}"), F.lit(i)).otherwise(fold)
    return df.join(F.broadcast(cuts), label).withColumn(name, fold).drop(*[f"_cut_{t}" for t in targets])


def hash_sample(df: DataFrame, id_column: str, fraction: float) -> DataFrame:
    """The same rows on every run and engine: those whose id hash falls below the fraction."""
    return df.filter(hash32(F.col(id_column)) < F.lit(fraction) * 4294967296)


def hash_sample_n(df: DataFrame, id_column: str, n: int) -> DataFrame:
    """``n`` rows by smallest id hash; rows that share the id at the cut are kept or left together.

    The (hash, id) at place ``n`` is looked up and rows are compared with it, so the sample is
    neither sorted nor gathered in one task. A null id comes last and is never at a cut.
    """
    if n <= 0:
        return df.limit(0)
    place = hash32(F.col(id_column)), F.col(id_column)
    keys = df.select(*[c.alias(name) for c, name in zip(place, ("_h", "_id"))])
    levels = [F.floor(F.col("_h") / 1048576), F.col("_h")]
    cut = cut_rows(keys.filter("_id IS NOT NULL"), [], levels, ["_h", "_id"], {"n": F.lit(n)}).first()
    if cut is None:  # all rows with an id fit
        spare = n - keys.filter("_id IS NOT NULL").count()
        known = df.filter(F.col(id_column).isNotNull())
        return known.unionByName(df.filter(F.col(id_column).isNull()).limit(spare))
    return df.filter((place[0] < cut["_h"]) | ((place[0] == cut["_h"]) & (place[1] < cut["_id"])))


def split_summary(df: DataFrame, time_column: str, name: str = "split") -> DataFrame:
    """Rows, first and last time per split."""
    return df.groupBy(name).agg(
        F.count(F.lit(1)).alias("rows"), F.min(time_column).alias("start"), F.max(time_column).alias("end")
    )
