"""Small value expressions: classes, flags, rates, missing values."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from legwork.schemas import DELAY_CLASSES, DELAY_UPPER_BOUNDS, LANGUAGE_COUNTRIES


def delay_class(minutes: Column) -> Column:
    """Right-closed delay class; null stays null."""
    minutes = as_missing(minutes)
    expr = F.when(minutes.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(DELAY_UPPER_BOUNDS, DELAY_CLASSES):
        expr = expr.when(minutes <= bound, F.lit(label))
    return expr.otherwise(F.lit(DELAY_CLASSES[-1]))


def class_ordinal(label: Column) -> Column:
    """Ordinal of a class label, null when the label is unknown."""
    expr = F.when(label == DELAY_CLASSES[0], F.lit(0))
    for position, name in enumerate(DELAY_CLASSES[1:], start=1):
        expr = expr.when(label == name, F.lit(position))
    return expr


def as_missing(number: Column) -> Column:
    """NaN -> null."""
    return F.when(F.isnan(number.cast("double")), F.lit(None)).otherwise(number)


def to_number(text: Column) -> Column:
    """Anything -> double, null when it does not parse."""
    return text.try_cast("double")


def same(a: Column, b: Column) -> Column:
    """Equality in which a missing side counts as different."""
    return F.coalesce(a == b, F.lit(False))


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is 0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def rate(count: Column, rows: Column) -> Column:
    return count / F.greatest(rows, F.lit(1))


def is_blank(text: Column) -> Column:
    """True for text of nothing but white space."""
    return F.rlike(text, F.lit(r"(?U)\A\s*\z"))


def is_infinite(number: Column) -> Column:
    return F.abs(number) == F.lit(float("inf"))


def log10_plus(number: Column, offset: float = 1.0) -> Column:
    return F.log10(number + F.lit(offset))


def hash32(id_column: Column) -> Column:
    """Multiplicative hash of an integer id into [0, 2^32), the same in any engine."""
    folded = F.pmod(id_column.cast("bigint"), F.lit(4294967296).cast("bigint"))
    high = F.floor(folded / 65536).cast("bigint")
    low = folded % 65536
    # (high * 65536 + low) * m mod 2^32, kept inside 64 bits
    return F.pmod((high * 2654435761 % 65536) * 65536 + low * 2654435761, F.lit(4294967296).cast("bigint"))


def countries_of(language: Column) -> Column:
    """Countries that speak a language, null for an unmapped language."""
    pairs = chain.from_iterable(
        (F.lit(code), F.array(*[F.lit(c) for c in countries]))
        for code, countries in LANGUAGE_COUNTRIES.items()
    )
    return F.try_element_at(F.create_map(*pairs), language)
