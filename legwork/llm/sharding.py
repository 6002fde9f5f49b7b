"""Uniform shuffle into shards of exact size through a hypergeometric communication matrix.

The rows of every input partition are permuted in place and stored. A matrix says how many
rows each stored partition sends to each shard: its rows sum to the partition sizes, its
columns to the shard sizes, and its law is the multivariate hypergeometric one, so that the
result is a uniform shuffle. The first rows of a permuted partition go to shard 0, the next
to shard 1 and so on; after the exchange each shard is permuted again.

The matrix is drawn in two steps. The driver draws it for at most ``BLOCKS`` blocks of
partitions, and tasks draw the partitions of a block. Shards are permuted in cells of about
``cell_rows`` rows, so that no task holds a whole shard.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legwork.llm.text import free, pieces, plus, sized_broadcast
from legwork.session import cut_to_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Most blocks, and most entries of the block matrix, that the driver draws.
BLOCKS = 256
BLOCK_ENTRIES = 1 << 20
#: Above this numpy's own sampler refuses.
NUMPY_LIMIT = 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Number of good items among ``draws`` taken without return; any size of the urn."""
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws))
    low, high = max(0, draws - bad), min(draws, good)
    share = good / (good + bad)
    centre = min(max(int((draws + 1) * share), low), high)
    spread = 40 * int(np.sqrt(draws * share * (1 - share)) + 1)
    k = np.arange(max(low, centre - spread), min(high, centre + spread) + 1, dtype=np.float64)
    steps = np.log((good - k[:-1]) * (draws - k[:-1])) - np.log((k[:-1] + 1) * (bad - draws + k[:-1] + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return int(k[np.searchsorted(weights, rng.random() * weights[-1])])


def split_counts(rng: np.random.Generator, sizes: list[int], room: list[int]) -> np.ndarray:
    """Matrix with row sums ``sizes`` and column sums ``room`` under the hypergeometric law."""
    room = [int(x) for x in room]
    out = np.zeros((len(sizes), len(room)), dtype=np.int64)
    for i, size in enumerate(sizes):
        left, urn = int(size), sum(room)
        for j, inside in enumerate(room):
            if not left:
                break
            urn -= inside
            got = hypergeometric(rng, inside, urn, left) if urn else left
            out[i, j] = got
            room[j] -= got
            left -= got
    return out


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes that differ by one at most and sum to ``rows``."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def shard_rows(df: DataFrame, shards: int, seed: int = 0, cell_rows: int = 100_000) -> DataFrame:
    """``df`` with ``shard`` (int, 0 to shards - 1) and ``slot`` (long, gapless from 0 in a shard).

    Every row of the input, repeated rows and rows with nulls included, gets one place; values
    are not looked at. Shard sizes differ by one at most; with fewer rows than shards the last
    shards stay empty, and an empty table gives an empty table. Input columns named shard or
    slot give way. The result depends on the seed and on how the input is split into
    partitions; the permuted rows are stored once, so a lost executor changes nothing.
    """
    spark = df.sparkSession
    at, mix = free(df, "at"), free(df, "mix")
    stored = cut_to_table(
        df.withColumn(mix, F.rand(seed)).sortWithinPartitions(mix).drop(mix)
        .withColumn(at, F.monotonically_increasing_id()),
        "permuted",
    )
    part, place = F.shiftright(at, 33).alias("part"), F.col(at).bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(part).agg(F.count(F.lit(1)).alias("n"))

    blocks = max(1, min(BLOCKS, BLOCK_ENTRIES // shards))
    by_block = sizes.groupBy((F.col("part") % blocks).cast("int").alias("block")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")
    )
    totals = {r["block"]: (r["n"], r["parts"]) for r in by_block.collect()}  # at most BLOCKS rows
    rows, parts = sum(n for n, _ in totals.values()), sum(p for _, p in totals.values())
    order = sorted(totals)
    drawn = split_counts(np.random.default_rng(seed), [totals[b][0] for b in order], shard_sizes(rows, shards))
    room = dict(zip(order, drawn, strict=True))

    def draw(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        rng = np.random.default_rng([seed, 1 + int(key[0])])
        counts = split_counts(rng, frame["n"].tolist(), room[int(key[0])])
        return pd.DataFrame({"part": frame["part"], "until": list(np.cumsum(counts, axis=1))})

    cells = cut_to_table(
        sizes.groupBy((F.col("part") % blocks).cast("int").alias("block")).applyInPandas(
            draw, "part long, until array<long>"
        ),
        "matrix",
    )
    cells = sized_broadcast(cells, parts, 8 * shards + 32)

    # The shard is the number of shards that end at or before the row's place.
    until = free(df, "until")
    sent = plus(stored, **{mix: part}).join(cells.withColumnsRenamed({"part": mix, "until": until}), mix)
    upto = F.filter(until, lambda end: end <= place)
    sent = plus(sent, shard=F.size(upto).cast("int")).drop(until, mix)

    # Permute again: order by a seeded hash, in cells cut by its top 31 bits.
    per_shard = pieces(rows, shards * cell_rows)
    turn, cell = free(df, "turn"), free(df, "cell")
    turned = sent.withColumn(turn, F.xxhash64(F.lit(seed + 1), F.col(at)))
    turned = turned.withColumn(
        cell, F.shiftright(F.shiftrightunsigned(turn, 33) * F.lit(per_shard), 31).cast("int")
    )
    counted = turned.groupBy("shard", cell).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    first = cut_to_table(
        counted.select("shard", cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "offsets"
    )
    start = free(df, "start")
    first = sized_broadcast(first.withColumnRenamed("first", start), shards * per_shard, 40)
    within = Window.partitionBy("shard", cell).orderBy(turn, at)
    placed = turned.withColumn(mix, F.row_number().over(within)).join(first, ["shard", cell])
    names = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    return placed.select(
        *[F.col(f"`{c}`") for c in names], "shard", (F.col(start) + F.col(mix) - 1).cast("long").alias("slot")
    )
