"""Word and column helpers shared by the corpus operators; all of them are plain expressions."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words, and the letters that are lower-cased.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Explicit broadcasts stay below this many bytes; larger tables are joined by shuffle.
BROADCAST_BYTES = 32 << 20


def filled(text: Column | str) -> Column:
    """Text, with null as the empty text."""
    return F.coalesce(text, F.lit(""))


def words(text: Column | str) -> Column:
    """Array of the runs of characters other than white space; empty for null."""
    inner = F.btrim(filled(text), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def ascii_lower(text: Column | str) -> Column:
    """Lower-cases A-Z and leaves all other letters."""
    return F.translate(text, UPPER, LOWER)


def text_key(text: Column | str) -> Column:
    """64-bit hash that tells the texts of one document id apart; null has its own value."""
    return F.xxhash64(text)


def plus(df: DataFrame, **new: Column) -> DataFrame:
    """``df`` with the new columns at the end; input columns of the same name give way."""
    taken = {name.lower() for name in new}
    old = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*old, *[value.alias(name) for name, value in new.items()])


def free(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in have:
        name += "_"
    return name


def shielded(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns under names that no operator uses, and these names by their own."""
    inner = {name: f"_own_{i}" for i, name in enumerate(df.columns)}
    return df.toDF(*[f"_own_{i}" for i in range(len(df.columns))]), inner


def unshielded(df: DataFrame, inner: dict[str, str], **new: Column) -> DataFrame:
    """The columns of before under their own names, then the new ones; old ones of a new name give way."""
    taken = {name.lower() for name in new}
    kept = [F.col(held).alias(name) for name, held in inner.items() if name.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in new.items()])


def sized_broadcast(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Marks ``df`` for broadcast when its counted size is small, else leaves the join to Spark."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def same(left: Iterable[Column], right: Iterable[Column]) -> Column:
    """Join condition in which nulls equal each other."""
    terms = [a.eqNullSafe(b) for a, b in zip(left, right, strict=True)]
    out = terms[0]
    for term in terms[1:]:
        out = out & term
    return out


def pieces(total: int, each: int) -> int:
    """How many pieces of at most ``each`` make up ``total``; at least one."""
    return max(1, math.ceil(total / each))
