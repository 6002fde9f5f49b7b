"""Categories -> indicator columns; feature matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwork import schemas
from legwork.operators.ranking import positions


def fit_categories(train: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct values per column.

    Indicator columns are part of the schema, so the driver has to know the values while
    the plan is built; there are as many as the result has columns.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    found = train.select(F.inline(pairs)).filter("value IS NOT NULL").distinct().collect()
    return {c: sorted(r["value"] for r in found if r["column"] == c) for c in columns}


def one_hot(df: DataFrame, categories: dict[str, list[str]], null_column: bool = False) -> DataFrame:
    """Replaces each column by its indicators; an unseen value gives only zeros."""
    added = {}
    for c, values in categories.items():
        for v in values:
            added[f"{c}_{v}"] = F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0))
        if null_column:
            added[f"{c}_nan"] = F.col(c).isNull().cast("double")
    kept = [c for c in df.columns if c not in categories]
    return df.select(*kept, *[x.alias(n) for n, x in added.items()])


def fit_dictionary(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, index): the distinct values of every column, numbered from 0 in their order.

    The values stay in Spark: they are counted by their first characters and numbered inside
    these cells, so neither the driver nor one task holds those of a column.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    found = train.select(F.inline(pairs)).filter("value IS NOT NULL").distinct()
    cells = [F.substring("value", 1, 1), F.substring("value", 1, 3)]
    placed = positions(found, ["column"], cells, ["value"], "index")
    return placed.select("column", "value", F.col("index").cast("int").alias("index"))


#: Values of a column that every task may hold: their numbers are joined without a shuffle of the rows.
FEW_VALUES = 1 << 16


def add_indices(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], few: Sequence[str] = ()) -> DataFrame:
    """Adds ``<column>_index``, null for a null and for a value that the dictionary lacks.

    Columns ``few`` have at most ``FEW_VALUES`` values.
    """
    for c in columns:
        own = dictionary.filter(F.col("column") == c).select(F.col("value").alias(c), F.col("index").alias(f"{c}_index"))
        own = F.broadcast(own) if c in few else own
        df = df.withColumn(c, F.col(c).cast("string")).join(own, c, "left")
    return df


def one_hot_vectors(df: DataFrame, dictionary: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Adds a sparse indicator vector per column and returns the names of these vectors.

    An unseen or missing value gives an empty vector. Only the number of values of a column
    reaches the driver, and no column is made per value.
    """
    counted = dictionary.groupBy("column").agg((F.max("index") + 1).alias("n")).collect()  # one row per column
    sizes = {r["column"]: r["n"] for r in counted}
    known = [c for c in columns if c in sizes]
    few = [c for c in known if sizes[c] <= FEW_VALUES]
    coded = add_indices(df, dictionary, known, few).withColumns(
        {f"{c}_index": F.coalesce(f"{c}_index", F.lit(sizes[c])).cast("double") for c in known}
    )
    if not known:
        return coded, []
    vectors = [f"{c}_vector" for c in known]
    encoder = OneHotEncoder(inputCols=[f"{c}_index" for c in known], outputCols=vectors, handleInvalid="keep", dropLast=True)
    widest = df.sparkSession.createDataFrame([tuple(float(sizes[c] - 1) for c in known)], [f"{c}_index" for c in known])
    return encoder.fit(widest).transform(coded).drop(*[f"{c}_index" for c in known]), vectors


def place_of(vector: Column | str) -> Column:
    """Place of the only entry of a sparse indicator vector, null if it is empty.

    The stored indices are read, so a row costs the same however long the vector is.
    """
    return F.get(F.unwrap_udt(vector)["indices"], F.lit(0))


def drop_leakage(df: DataFrame, target: str, time_column: str, extra: Sequence[str] = ()) -> DataFrame:
    """Removes outcome columns, target, times and dates; absent names are ignored."""
    kept = df.drop(*schemas.LEAKAGE_COLUMNS, target, time_column, "FlightDate", *extra)
    temporal = (T.TimestampType, T.TimestampNTZType, T.DateType)
    return kept.drop(*[f.name for f in kept.schema.fields if isinstance(f.dataType, temporal)])


def feature_matrix(
    df: DataFrame, target: str, time_column: str, key: str, extra_drop: Sequence[str] = ()
) -> DataFrame:
    """Key, label text and indicator-encoded features; missing numbers count 0."""
    label = df.select(key, F.col(target).cast("string").alias("_label"), *[c for c in df.columns if c != key])
    features = drop_leakage(label, target, time_column, extra_drop)
    texts = [f.name for f in features.schema.fields if isinstance(f.dataType, T.StringType) and f.name != "_label"]
    coded = one_hot(features, fit_categories(features, texts), null_column=True) if texts else features
    numbers = [c for c in coded.columns if c not in (key, "_label")]
    return coded.withColumnRenamed("_label", "label").fillna(0, subset=numbers)
