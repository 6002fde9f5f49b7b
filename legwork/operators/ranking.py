"""Positions, prefix sums, cut rows and exact quantiles without one big sort.

A running sum over a whole table, or over a key that holds a third of it, must not
run in one task. Each operator here first counts coarse cells of the order (an hour, a
value range), runs the prefix over the cells, and only orders rows inside a cell.
The number of cells is bounded by the calendar or by the value range, not by the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwork.session import cut_lineage

#: Cell of rows without a time where they come after all others.
LAST_HOUR = datetime(9999, 12, 31, 23)


def _before(keys: Sequence[str], order: list) -> "Window":
    return (
        Window.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def _join_same(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Joins on ``names``, nulls equal to each other, and keeps the columns of ``left`` once."""
    if not names:
        return left.join(right, how=how)
    other = right.withColumnsRenamed({n: f"_r_{n}" for n in names})
    terms = [left[n].eqNullSafe(other[f"_r_{n}"]) for n in names]
    return left.join(other, terms, how).drop(*[f"_r_{n}" for n in names])


#: Columns added by ``_keyed``.
KEYED = ["_hash", "_key"]


def _keyed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Adds one value for all of ``names``, in which null is a value like any other, and its hash.

    A join and a window on these two share one shuffle, where a null-safe join would deal the rows
    by expressions that no window is partitioned by. The hash comes first as it sorts faster. A
    window should name the columns too, or filters on them are not moved below it.
    """
    return df.withColumns({"_hash": F.xxhash64(*names), "_key": F.struct(*names)})


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    levels: Sequence[Column],
    order: Sequence[str | Column],
    weights: dict[str, Column],
    totals: bool = False,
) -> DataFrame:
    """Exclusive running sums of ``weights`` in ``order`` within ``keys``.

    ``levels`` are coarse-to-fine cells that never decrease along ``order``; a null cell or key
    is a cell or key of its own, before all others. With ``totals`` the sum over the key is
    added as ``<name>_total``.
    """
    keys = list(keys)
    names = [f"_cell{i}" for i in range(len(levels))]
    tagged = df.withColumns(dict(zip(names, levels)))
    cells = tagged.groupBy(*keys, *names).agg(
        *[F.sum(w).alias(f"_w_{n}") for n, w in weights.items()]
    )
    offsets = None
    for depth, name in enumerate(names):
        outer = keys + names[:depth]
        group = outer + [name]
        # the finest cells are counted already
        level = cells if depth == len(names) - 1 else cells.groupBy(*group).agg(
            *[F.sum(f"_w_{n}").alias(f"_w_{n}") for n in weights]
        )
        window = _before(outer, [name])
        level = level.withColumns(
            {f"_p_{n}": F.coalesce(F.sum(f"_w_{n}").over(window), F.lit(0)) for n in weights}
        )
        if totals and depth == 0:
            whole = Window.partitionBy(*keys)
            level = level.withColumns({f"{n}_total": F.sum(f"_w_{n}").over(whole) for n in weights})
        level = level.drop(*[f"_w_{n}" for n in weights])
        if offsets is None:
            offsets = level.withColumnsRenamed({f"_p_{n}": f"_off_{n}" for n in weights})
        else:
            offsets = _join_same(level, offsets, outer).withColumns(
                {f"_off_{n}": F.col(f"_off_{n}") + F.col(f"_p_{n}") for n in weights}
            ).drop(*[f"_p_{n}" for n in weights])
    inside = _before(KEYED + keys + names, list(order))
    return (
        _keyed(tagged, keys + names)
        .join(_keyed(offsets, keys + names).drop(*keys, *names), KEYED)
        .withColumns(
            {
                n: F.col(f"_off_{n}") + F.coalesce(F.sum(w).over(inside), F.lit(0))
                for n, w in weights.items()
            }
        )
        .drop(*names, *KEYED, *[f"_off_{n}" for n in weights])
    )


def positions(
    df: DataFrame,
    keys: Sequence[str],
    levels: Sequence[Column],
    order: Sequence[str | Column],
    name: str = "position",
    totals: bool = False,
) -> DataFrame:
    """Zero-based position of each row in ``order`` within ``keys``."""
    return prefix_sums(df, keys, levels, order, {name: F.lit(1)}, totals)


def cut_rows(
    df: DataFrame,
    keys: Sequence[str],
    levels: Sequence[Column],
    order: Sequence[str],
    targets: dict[str, Column],
) -> DataFrame:
    """The order values found at given positions of each key.

    ``targets`` maps a name to a position written over the column ``n``, the number of
    rows of the key. The result has one row per key and name, and is computed at once.
    A position outside the key yields no row. Only rows of a cell that holds a target are looked at
    again, so no step ranks the whole table.
    """
    keys = list(keys)
    names = [f"_cell{i}" for i in range(len(levels))]
    tagged = df.select(*keys, *order, *[c.alias(n) for n, c in zip(names, levels)])
    wanted = None
    group = list(keys)
    for depth, name in enumerate(names):
        outer, group = group, group + [name]
        source = tagged
        if wanted is not None:
            source = tagged.join(wanted.select(*outer).distinct(), outer, "left_semi")
        counted = source.groupBy(*group).agg(F.count(F.lit(1)).alias("_c"))
        counted = counted.withColumn(
            "_off", F.coalesce(F.sum("_c").over(_before(outer, [name])), F.lit(0))
        )
        if depth == 0:
            counted = counted.withColumn("n", F.sum("_c").over(Window.partitionBy(*keys)))
            pairs = F.array(
                *[
                    F.struct(F.lit(t).alias("cut"), p.cast("bigint").alias("rest"))
                    for t, p in targets.items()
                ]
            )
            counted = counted.select("*", F.inline(pairs)).drop("n")
        else:
            counted = counted.join(wanted, outer)
        wanted = counted.filter(
            (F.col("rest") >= F.col("_off")) & (F.col("rest") < F.col("_off") + F.col("_c"))
        ).select(*group, "cut", (F.col("rest") - F.col("_off")).alias("rest"))
        # one row per key and target; the next level reads it twice
        wanted = cut_lineage(wanted)
    rows = tagged.join(wanted.select(*group).distinct(), group, "left_semi")
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1
    ranked = rows.withColumn("_rank", rank.cast("bigint"))
    return (
        ranked.join(wanted, group)
        .filter(F.col("_rank") == F.col("rest"))
        .select(*keys, "cut", *order)
    )


def value_levels(value: Column) -> list[Column]:
    """Cells of a number that spread small and large magnitudes alike."""
    size = F.signum(value) * F.log1p(F.abs(value))
    return [F.floor(size * 64), F.floor(size * 65536)]


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float]
) -> DataFrame:
    """Linearly interpolated quantiles per key, nulls skipped.

    Equal values are counted first, then the counted values are ranked by cells.
    """
    keys = list(keys)
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = prefix_sums(
        counted, keys, value_levels(F.col("_v")), ["_v"], {"_at": F.col("_n")}, totals=True
    )
    picks = []
    for name, p in probabilities.items():
        place = (F.col("_at_total") - 1) * F.lit(float(p))
        low, high = F.floor(place), F.ceil(place)

        def at(position: Column) -> Column:
            covers = (position >= F.col("_at")) & (position < F.col("_at") + F.col("_n"))
            return F.max(F.when(covers, F.col("_v")))

        picks += [
            at(low).alias(f"_lo_{name}"),
            at(high).alias(f"_hi_{name}"),
            F.max(place - low).alias(f"_fr_{name}"),
        ]
    found = ranked.groupBy(*keys).agg(*picks)
    return found.select(
        *keys,
        *[
            (
                F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_fr_{n}")
            ).alias(n)
            for n in probabilities
        ],
    )


def previous_row(
    df: DataFrame,
    key: str,
    cell: Column,
    order: Sequence[str],
    fields: Sequence[str],
    name: str,
) -> DataFrame:
    """Adds ``name``: a struct of ``fields`` taken from the previous row of the key.

    Rows are ordered inside (key, cell) only, and the last row of each cell is carried to
    the next one over a table with one row per cell, so that no task holds a whole key. Rows
    with a null cell or order value come last.
    Rows with a null key have no previous row and take no part in the shuffles.
    """
    held = F.struct(*fields)
    group = [key, "_cell"]
    known = df.filter(F.col(key).isNotNull()).withColumn("_cell", cell)
    ranks = [x for c in order for x in (F.col(c).isNull(), F.col(c))]
    last = known.groupBy(*group).agg(F.max_by(held, F.struct(*ranks)).alias("_last"))
    by_cell = Window.partitionBy(key).orderBy(F.asc_nulls_last("_cell"))
    carried = last.select(*group, F.lag("_last").over(by_cell).alias("_carried"))
    inside = Window.partitionBy(*KEYED, *group).orderBy(*[F.asc_nulls_last(c) for c in order])
    linked = _keyed(known, group).join(_keyed(carried, group).drop(*group), KEYED, "left").withColumn(
        name, F.coalesce(F.lag(held).over(inside), F.col("_carried"))
    )
    linked = linked.drop("_cell", "_carried", *KEYED)
    blank = F.lit(None).cast(linked.schema[name].dataType)
    return linked.unionByName(df.filter(F.col(key).isNull()).withColumn(name, blank))
