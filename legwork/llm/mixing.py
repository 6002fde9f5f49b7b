"""Mixing sources to target weights.

Sizes are summed per source, targets follow from the weights, and a source's repetition rate
is its target over its size. A document is emitted floor(rate) times, and once more with the
fraction as probability, decided by a hash of the seed, its id, its text and, where rows repeat, of
their number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwork.llm.text import BROADCAST_BYTES, filled, free, shielded, sized_broadcast, text_key, unshielded, words
from legwork.session import cut_to_table

#: Bits of the hash that make the uniform number; a double holds them exactly.
HASH_DIGITS = 13


def source_rates(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Per source of ``sizes`` (source, size): source_size, weight, target and rate.

    Sources in code point order, null last, take the weights in turn. Targets share ``share``
    times all sizes by weight, stop at ``most`` times the source's size, and what is above is
    shared again among the others. With caps in order of cap over weight this is a prefix of
    sources at their cap and one common level for the rest, found from running sums. A source
    of size 0 has target 0 and rate 0. One row per source passes through a single task, never
    rows of documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    capped = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    line = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    level = (
        F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levels = capped.withColumn("level", level).withColumn("place", F.row_number().over(line))
    levels = levels.withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
    common = F.min(F.when(~F.col("full"), F.struct("place", "level"))).over(every)["level"]
    levels = levels.withColumn("common", common)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("common"))
    return levels.select("source", "source_size", "weight", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    )


def uniform(seed: int, key: Column, text: Column, number: Column) -> Column:
    """Number in [0, 1) from the MD5 of seed, id, text and the number of a repeated row."""
    again = F.when(number > 0, F.concat(F.lit("|"), number.cast("string"))).otherwise(F.lit(""))
    digest = F.md5(
        F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit("")), F.lit("|"), F.md5(filled(text)), again)
    )
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double") / float(16**HASH_DIGITS)


def numbered(docs: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """``docs`` with ``name``: different numbers for rows of the same id and text, 0 for all others.

    Only the ids are counted first. Rows of repeated ids are numbered within their partition of
    the input, so a row that makes up a third of the table is not gathered in one task.
    """
    counted = docs.groupBy(F.col(id_col).alias("id")).count().filter("count > 1").select("id")
    counted = cut_to_table(counted, "repeated_ids")
    held = counted.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length(F.col("id").cast("string"))).alias("b")).first()
    first = docs.withColumn(name, F.lit(0).cast("long"))
    if not held["n"]:
        return first
    counted = sized_broadcast(counted.withColumnRenamed("id", free(docs, "repeated")), held["n"], 32 + (held["b"] or 0))
    met = F.col(id_col).eqNullSafe(F.col(counted.columns[0]))
    part, mark = free(docs, "part"), free(docs, "mark")
    again = docs.withColumns({part: F.spark_partition_id(), mark: text_key(F.col(text_col))}).join(counted, met, "left_semi")
    same_rows = Window.partitionBy(id_col, mark, part).orderBy(mark)
    number = F.col(part).cast("long") * (1 << 33) + F.row_number().over(same_rows) - 1
    again = again.withColumn(name, number).drop(part, mark)
    return first.join(counted, met, "left_anti").unionByName(again)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` with size (words of the text), source_size, target, rate and copies.

    A null or empty text has size 0; a null source is a source of its own. Repeated rows draw
    each for itself, by a number that depends on how the input is split into partitions; all other
    rows depend on the seed, id and text only. So the same input and seed always give the same
    copies. A very long text is one document like any other. Input columns of the new names give
    way. An empty table gives an empty one.
    """
    docs, names = shielded(docs)
    id_col, text_col, source_col = names[id_col], names[text_col], names[source_col]
    size = F.size(words(text_col)).cast("long")
    rates = cut_to_table(
        source_rates(docs.select(F.col(source_col).alias("source"), size.alias("size")), weights, share, most), "rates"
    )
    held = rates.agg(F.sum(F.lit(64) + F.octet_length(filled("source"))).alias("b")).first()["b"]
    rates = rates.select(
        F.col("source").alias("_mix_source"), F.col("source_size").alias("_mix_size"),
        F.col("target").alias("_mix_target"), F.col("rate").alias("_mix_rate"),
    )
    if (held or 0) <= BROADCAST_BYTES:
        rates = F.broadcast(rates)
    docs = numbered(docs, id_col, text_col, "_mix_number")
    joined = docs.join(rates, F.col(source_col).eqNullSafe(F.col("_mix_source")), "left")
    rate, chance = F.col("_mix_rate"), uniform(seed, F.col(id_col), F.col(text_col), F.col("_mix_number"))
    copies = F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")
    return unshielded(
        joined, names, size=size, source_size=F.col("_mix_size"), target=F.col("_mix_target"), rate=rate,
        copies=copies.cast("long"),
    )


def emit_copies(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: ``columns`` of each document, as often as ``copies`` says."""
    times, copy = F.array_repeat(F.lit(1), F.col("copies").cast("int")), free(mixed, "copy")
    return mixed.select(*[F.col(f"`{c}`") for c in columns], F.explode(times).alias(copy)).drop(copy)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as often as the mix takes each row, with their own columns whatever their names.

    See ``mix`` for nulls, empty and very long texts, repeated rows and empty tables.
    """
    inside, names = shielded(docs)
    columns = {f"{kind}_col": names[options.pop(f"{kind}_col", name)] for kind, name in (("id", "doc_id"), ("text", "text"), ("source", "source"))}
    return unshielded(emit_copies(mix(inside, **columns, **options), inside.columns), names)
