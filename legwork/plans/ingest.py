"""Raw monthly files -> cleaned legs -> feature table, as one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from legwork import schemas
from legwork.operators import clean
from legwork.plans.features import feature_table
from legwork.session import cut_to_table
from legwork.sources import sinks, tables


def months_to_legs(
    spark: SparkSession,
    root: str,
    years: Sequence[int],
    airports: DataFrame,
    output: str,
    months: Sequence[int] = tuple(range(1, 13)),
    airlines: Sequence[str] = tuple(schemas.SCOPE_AIRLINES),
    scope: Sequence[str] = tuple(schemas.SCOPE_AIRPORTS),
) -> DataFrame:
    """Reads the monthly files, keeps the scope, numbers and cleans the legs and stores them.

    The text is parsed once: numbering reads the kept records twice, from Parquet.
    """
    raw = tables.read_months(spark, root, years, months).drop("source_file")
    kept = cut_to_table(clean.in_scope(raw, list(airlines), list(scope)), "raw_legs")
    path = sinks.write_legs(clean.clean_legs(clean.add_flight_id(kept), airports), output)
    return sinks.read_legs(spark, path)


def months_to_features(
    spark: SparkSession,
    root: str,
    years: Sequence[int],
    airports: DataFrame,
    readings: DataFrame,
    output: str,
    months: Sequence[int] = tuple(range(1, 13)),
    airlines: Sequence[str] = tuple(schemas.SCOPE_AIRLINES),
    scope: Sequence[str] = tuple(schemas.SCOPE_AIRPORTS),
    min_year: int = 2014,
    keep_keys: bool = False,
) -> DataFrame:
    """The feature table of the monthly files; ``output`` names the folder of the cleaned legs."""
    legs = months_to_legs(spark, root, years, airports, output, months, airlines, scope)
    return feature_table(legs, airports, readings, scope, min_year, keep_keys)
