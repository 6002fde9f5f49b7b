"""Column and row profiles, quality issues, histograms, correlations."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwork import schemas
from legwork.functions.scalars import is_blank, is_infinite, rate
from legwork.operators.clean import completed
from legwork.operators.ranking import exact_quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FLOATING = (T.FloatType, T.DoubleType)
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
ATOMIC = (*NUMERIC, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

#: Bits of one bitmap of ``bitmap_construct_agg``; Spark fixes it.
BITMAP_BITS = 1 << 15
#: Columns whose bitmaps one aggregate builds; each such pack is merged by a task of its own.
PACK_COLUMNS = 16


def columns_of(df: DataFrame, kinds) -> list[str]:
    """Names of the columns whose type is one of ``kinds``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def _q(name: str) -> str:
    return f"`{name}`"


def _per_column(df: DataFrame, columns: Sequence[str], count, name: str) -> DataFrame:
    """One pass: ``count(column)`` per column, as rows (column, name, rate of rows)."""
    summed = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.coalesce(F.sum(count(F.col(_q(c))).cast("bigint")), F.lit(0)).alias(c) for c in columns],
    )
    long = summed.unpivot("_rows", list(columns), "column", f"{name}_count")
    return long.select("column", f"{name}_count", rate(F.col(f"{name}_count"), F.col("_rows")).alias(f"{name}_rate"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and rate per column."""
    return _per_column(df, columns or df.columns, lambda c: c.isNull(), "null")


def nan_profile(df: DataFrame) -> DataFrame:
    """NaN and infinite counts of the floating-point columns."""
    floats = columns_of(df, FLOATING)
    nans = _per_column(df, floats, lambda c: F.coalesce(F.isnan(c), F.lit(False)), "nan")
    infinite = _per_column(df, floats, lambda c: F.coalesce(is_infinite(c), F.lit(False)), "infinite")
    return nans.join(infinite, "column")


def blank_profile(df: DataFrame) -> DataFrame:
    """Counts of strings that hold white space only."""
    texts = columns_of(df, T.StringType)
    return _per_column(df, texts, lambda c: F.coalesce(is_blank(c), F.lit(False)), "blank_string")


def value_counts_long(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, rows) for every distinct value; long text is held by its digest.

    One grouped count per column: each reads its column alone and sums before the shuffle. Zero and
    negative zero are one value.
    """
    names = [n for n in df.columns if columns is None or n in columns]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, value string, rows bigint")
    return reduce(DataFrame.unionAll, [
        _values(df, n).groupBy("value").agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(n).alias("column"), F.col("value").cast("string").alias("value"), "rows")
        for n in names
    ])


def _values(df: DataFrame, name: str) -> DataFrame:
    """One column as ``value``, in a form that can be grouped."""
    rows = df.select(F.col(_q(name)).alias("value"))
    if isinstance(rows.schema["value"].dataType, ATOMIC):
        return rows
    return rows.select(F.col("value").cast("string").alias("value")).select(_held("value").alias("value"))


def _held(value: str) -> Column:
    """What stands for a value while values are counted."""
    return F.when(F.length(value) > 64, F.sha2(value, 256)).otherwise(F.col(value))


def unique_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values per column without and with null, null count, mode and its share."""
    counts = value_counts_long(df, columns)
    ordered = F.struct(F.col("rows"), F.col("value"))
    profile = counts.groupBy("column").agg(
        F.count("value").alias("unique_values"),
        F.count(F.lit(1)).alias("unique_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("rows"))), F.lit(0)).alias("nan_values"),
        F.max_by("value", F.when(F.col("value").isNotNull(), ordered)).alias("mode"),
        (F.max(F.when(F.col("value").isNotNull(), F.col("rows"))) / F.sum("rows")).alias("mode_share"),
    )
    # Only where a digest won is the text itself looked up: one row per column.
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    texts = [n for n in texts if columns is None or n in columns]
    if not texts:
        return profile
    long_text = reduce(DataFrame.unionAll, [
        df.select(F.lit(n).alias("column"), F.col(_q(n)).alias("value")).filter(F.length("value") > 64) for n in texts
    ])
    won = profile.select("column", F.col("mode").alias("_won")).filter(F.length("_won") == 64)
    full = (
        long_text.withColumn("_won", _held("value")).join(won, ["column", "_won"])
        .groupBy("column").agg(F.max("value").alias("_full"))
    )
    names = profile.columns
    profile = profile.join(full, "column", "left").withColumn("mode", F.coalesce("_full", "mode"))
    return profile.select(*names)


def _as_whole(df: DataFrame, name: str) -> Column | None:
    """A column as whole numbers, one per value; null where the value is no whole number."""
    value, kind = F.col(_q(name)), df.schema[name].dataType
    if isinstance(kind, WHOLE):
        return value.cast("bigint")
    if isinstance(kind, T.BooleanType):
        return value.cast("int").cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, FLOATING):
        return F.when((F.rint(value) == value) & (F.abs(value) < 2.0**53), value.cast("bigint"))
    return None


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact distinct values and nulls per column: (column, unique_values, nan_values).

    One pass finds the range of every column of whole numbers, dates or truth values (floating-point
    columns count if all their values are whole). Ranges of at most 32,768 become one bitmap each, and
    up to 16 columns share a scan that ships a bitmap per column and partition. Wider ranges are
    bitmaps per bucket while those are smaller than the values of a partition. What is left (texts,
    fractions, sparse numbers) is grouped by value, column by column: the list of its values would be
    the dictionary itself. Rows are never unfolded into one row per column. The way taken changes the
    cost, not the result.

    NaN is one value; zero and negative zero are the same one; a column of nulls has none. An empty
    table gives zeros. Long texts are compared by SHA-256. Repeated column names are an error.
    """
    names = [n for n in df.columns if columns is None or n in columns]
    whole = {n: number for n in names if (number := _as_whole(df, n)) is not None}
    part = _free_name(df, "part")
    stats = df.withColumn(part, F.spark_partition_id()).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.coalesce(F.max(part), F.lit(0)) + 1).alias("parts"),
        *[F.count(_q(n)).alias(f"known_{i}") for i, n in enumerate(names)],
        *[f(whole[n]).alias(f"{f.__name__}_{i}") for i, n in enumerate(names) if n in whole for f in (F.count, F.min, F.max)],
    ).first()  # one row

    settled, narrow, branches = [], [], []
    for i, n in enumerate(names):
        known = stats[f"known_{i}"]
        nulls = stats["rows"] - known
        bits = n in whole and stats[f"count_{i}"] == known
        low, high = (stats[f"min_{i}"], stats[f"max_{i}"]) if bits else (None, None)
        if known == 0 or (bits and low == high):
            settled.append((n, min(known, 1), nulls))
        elif bits and high - low < BITMAP_BITS:
            narrow.append((n, whole[n] - F.lit(low), nulls))
        elif bits and high - low < 128 * stats["rows"] / stats["parts"]:  # 1 bit against 16 bytes a value
            branches.append(_bucket_bits(df, n, whole[n] - F.lit(low), nulls))
        else:
            found = _values(df, n).filter("value IS NOT NULL").distinct().agg(F.count("value").alias("unique_values"))
            branches.append(found.select(*_counted(n, "unique_values", nulls)))
    for start in range(0, len(narrow), PACK_COLUMNS):
        branches.append(_packed_bits(df, narrow[start:start + PACK_COLUMNS]))
    schema = "column string, unique_values bigint, nan_values bigint"
    return reduce(DataFrame.unionAll, branches, df.sparkSession.createDataFrame(settled, schema))


def _free_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def _counted(name: str, unique: Column | str, nulls: int) -> list[Column]:
    unique = F.col(unique) if isinstance(unique, str) else unique
    return [F.lit(name).alias("column"), unique.cast("bigint").alias("unique_values"), F.lit(nulls).cast("bigint").alias("nan_values")]


def _packed_bits(df: DataFrame, pack: Sequence[tuple[str, Column, int]]) -> DataFrame:
    """Counts of several columns from one scan, one bitmap per column."""
    maps = df.agg(*[F.bitmap_construct_agg(place).alias(f"b{i}") for i, (_, place, _) in enumerate(pack)])
    entries = [F.struct(*_counted(n, F.bitmap_count(f"b{i}"), nulls)) for i, (n, _, nulls) in enumerate(pack)]
    return maps.select(F.array(*entries).alias("e")).select(F.inline("e"))


def _bucket_bits(df: DataFrame, name: str, place: Column, nulls: int) -> DataFrame:
    """Count of one column from bitmaps of 32,768 neighbouring values."""
    rows = df.select((place + 1).alias("place")).filter("place IS NOT NULL")
    maps = rows.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    counted = maps.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("unique_values"))
    return counted.select(*_counted(name, "unique_values", nulls))


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with at most one distinct value, null counted as a value; one pass, nothing exploded."""
    names = [n for n in df.columns if columns is None or n in columns]
    text = {n: F.col(_q(n)).cast("string") for n in names}
    packed = [
        F.struct(
            F.lit(n).alias("column"),
            F.count(F.lit(1)).alias("rows"),
            F.count(text[n]).alias("known"),
            (F.min(text[n]) == F.max(text[n])).alias("one"),
        )
        for n in names
    ]
    found = df.agg(F.array(*packed).alias("p")).select(F.inline("p"))
    single = (F.col("known") == 0) | (F.col("one") & (F.col("known") == F.col("rows")))
    return found.filter(single & (F.col("rows") > 0)).select("column", F.lit(1).cast("bigint").alias("unique_count"))


def duplicate_counts(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows that share their key with another row: all members, and the extras only.

    Rows are compared by a digest of the key columns, so wide rows are not shuffled.
    """
    keys = keys or df.columns
    digest = F.sha2(F.to_json(F.struct(*[F.col(_q(k)) for k in keys])), 256)
    groups = df.groupBy(digest.alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicated"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"),
    )


def duplicate_names(df: DataFrame) -> list[str]:
    return sorted({c for c in df.columns if df.columns.count(c) > 1})


def _numbered(names: Sequence[str]) -> list[str]:
    """Names made different: a repeated one carries its place among its equals."""
    seen, result = Counter(), []
    for name in names:
        seen[name] += 1
        result.append(name if seen[name] == 1 else f"{name}#{seen[name]}")
    return result


def numeric_profile(df: DataFrame) -> DataFrame:
    """Minimum, maximum, mean, deviation, zeros and negatives of every numeric column."""
    names = columns_of(df, NUMERIC)
    packed = [
        F.struct(
            F.lit(n).alias("column"),
            F.min(_q(n)).cast("double").alias("min"),
            F.max(_q(n)).cast("double").alias("max"),
            F.avg(_q(n)).alias("mean"),
            F.stddev_samp(_q(n)).alias("std"),
            F.count_if(F.col(_q(n)) == 0).alias("zero_count"),
            F.count_if(F.col(_q(n)) < 0).alias("negative_count"),
        )
        for n in names
    ]
    return df.agg(F.array(*packed).alias("p")).select(F.inline("p"))


def schema_report(df: DataFrame) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(t).alias("data_type")) for n, t in df.dtypes])
    return df.sparkSession.range(1).select(F.inline(pairs))


def column_catalogue(df: DataFrame, dropped: Sequence[str] = tuple(schemas.FEATURE_TABLE_DROPS)) -> DataFrame:
    """Type, distinct values, nulls, dropped flag and category of every column."""
    name = F.col("column")
    # a later rule wins over an earlier one
    category = (
        F.when(name.isin(schemas.REAL_TIME_COLUMNS), "Real time info")
        .when(name.isin(schemas.WEATHER_INFO_COLUMNS), "Weather_info")
        .when(name.isin(schemas.TIME_INFO_COLUMNS), "Time Info")
        .when(name.isin(schemas.LEG_INFO_COLUMNS), "Flight Information")
        .when(name.isin(schemas.TARGET_LIKE_COLUMNS), "Target Like")
        .when(name == schemas.DELAY_COLUMN, "Target")
        .otherwise("Undefined")
    )
    counted = distinct_counts(df)
    return schema_report(df).join(counted, "column", "left").select(
        "column",
        "data_type",
        F.coalesce("unique_values", F.lit(0)).alias("unique_values"),
        F.coalesce("nan_values", F.lit(0)).alias("nan_values"),
        name.isin(list(dropped)).cast("int").alias("dropped"),
        category.alias("category"),
    )


def completed_null_profile(legs: DataFrame, allowed: Sequence[str] = tuple(schemas.NULLS_ALLOWED)) -> DataFrame:
    """Nulls of completed legs next to all legs; a null that is not allowed is a problem."""
    everywhere = null_profile(legs).select("column", F.col("null_count").alias("missing"))
    flown = null_profile(completed(legs)).select("column", F.col("null_count").alias("really_missing"))
    return everywhere.join(flown, "column").filter("missing > 0").withColumn(
        "problem",
        ((F.col("really_missing") > 0) & ~F.col("column").isin(list(allowed))).cast("int"),
    )


def issue_report(df: DataFrame) -> DataFrame:
    """Quality findings with severity; a single ``ok`` row when there are none.

    Columns that share a name are reported, and looked at one by one: the second ``a`` is ``a#2``.
    """
    def lines(found: DataFrame, severity: str, check: str, count: str, what: str, share: str | None) -> DataFrame:
        number = F.format_number(F.col(count), 0)
        text = F.concat(F.col("column"), F.lit(": "), number, F.lit(f" {what}"))
        if share:
            text = F.concat(text, F.format_string(" (%.2f%%)", F.col(share) * 100))
        return found.filter(F.col(count) > 0).select(
            F.lit(severity).alias("severity"), F.lit(check).alias("check"), text.alias("details")
        )

    repeated = duplicate_names(df)
    if repeated:
        df = df.toDF(*_numbered(df.columns))
    rows = duplicate_counts(df)
    parts = [
        rows.filter("rows = 0").select(F.lit("error").alias("severity"), F.lit("row_count").alias("check"),
                                       F.lit("Dataframe is empty").alias("details")),
        rows.filter("duplicated > 0").select(
            F.lit("warning"), F.lit("duplicate_rows"),
            F.concat(F.format_number("duplicated", 0), F.lit(" duplicate rows"))),
        lines(null_profile(df), "warning", "null_values", "null_count", "nulls", "null_rate"),
        lines(constant_columns(df), "warning", "constant_column", "unique_count", "unique value(s)", None),
    ]
    if repeated:
        parts.append(df.sparkSession.range(1).select(
            F.lit("error"), F.lit("duplicate_columns"), F.lit(str(repeated))))
    if columns_of(df, FLOATING):
        floats = nan_profile(df)
        parts.append(lines(floats, "error", "nan_values", "nan_count", "NaNs", "nan_rate"))
        parts.append(lines(floats, "error", "infinite_values", "infinite_count", "infinite values", "infinite_rate"))
    if columns_of(df, T.StringType):
        parts.append(lines(blank_profile(df), "warning", "blank_strings", "blank_string_count",
                           "blank strings", "blank_string_rate"))
    found = reduce(DataFrame.union, parts)
    total = found.agg(F.count(F.lit(1))).scalar()
    fine = df.sparkSession.range(1).select(
        F.lit("ok").alias("severity"),
        F.lit("generic_quality_checks").alias("check"),
        F.lit("No obvious issues found by these generic checks").alias("details"),
    ).filter(total == 0)
    return found.union(fine)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes, exact quartiles and bias-corrected skew."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])
    long = df.select(F.inline(entries))
    n = F.count("x")
    moments = long.groupBy("column").agg(
        n.alias("count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        (F.skewness("x") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
    )
    quartiles = exact_quantiles(long, ["column"], "x", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return moments.join(quartiles, "column")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, long form, nulls dropped per pair."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    cells = []
    for a, b in pairs:
        value = F.corr(a, b)
        cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), value.alias("corr")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), value.alias("corr")))
    return df.agg(F.array(*cells).alias("c")).select(F.inline("c"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows and share per value, largest first; ties by value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    shared = counts.withColumn("share", F.col("rows") / total)
    return shared if top is None else shared.orderBy(F.desc("rows"), column).limit(top)


def _edges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Range of each column, fetched as one row; a constant column gets a unit interval."""
    row = df.agg(
        *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
        *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
    ).first()
    ranges = {}
    for c in columns:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        lo, hi = (0.0, 1.0) if lo is None else (lo, hi)
        ranges[c] = (lo, hi) if hi > lo else (lo - 0.5, hi + 0.5)
    return ranges


def _bin(column: str, edges: dict[str, tuple[float, float]], bins: int) -> Column:
    lo, hi = edges[column]
    place = F.floor((F.col(column) - lo) * bins / (hi - lo)).cast("int")
    return F.least(place, F.lit(bins - 1))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram, last bin closed, empty bins kept."""
    rows = df.filter(F.col(column).isNotNull()).select(column)
    edges = _edges(rows, [column])
    counts = rows.groupBy(_bin(column, edges, bins).alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    lo, hi = edges[column]
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * ((hi - lo) / bins)).alias("left_edge"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def histogram_2d(
    df: DataFrame, x: str, y: str, bins: int = 50, x_below: float | None = None, y_below: float | None = None
) -> DataFrame:
    """Counts of the occupied cells of a 2-D histogram."""
    rows = df.select(x, y).dropna()
    if x_below is not None:
        rows = rows.filter(F.col(x) < x_below)
    if y_below is not None:
        rows = rows.filter(F.col(y) < y_below)
    edges = _edges(rows, [x, y])
    return rows.groupBy(_bin(x, edges, bins).alias("x_bin"), _bin(y, edges, bins).alias("y_bin")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def _blur(cells: DataFrame, axis: str, other: str, bins: int, sigma: float) -> DataFrame:
    """One pass of a Gaussian blur along ``axis`` with mirrored borders."""
    radius = int(4 * sigma + 0.5)
    total = sum(math.exp(-0.5 * (j / sigma) ** 2) for j in range(-radius, radius + 1))
    place, step = F.col(axis), F.col("_step")
    images = F.array(place, -place - 1, F.lit(2 * bins - 1) - place)
    weight = F.exp(-0.5 * F.pow(step / sigma, F.lit(2))) / total
    target = F.col("_image") - step
    return (
        cells.select(other, "value", F.explode(images).alias("_image"))
        .select("*", F.explode(F.sequence(F.lit(-radius), F.lit(radius))).alias("_step"))
        .filter((target >= 0) & (target < bins))
        .groupBy(target.cast("int").alias(axis), other)
        .agg(F.sum(F.col("value") * weight).alias("value"))
    )


def point_density(
    df: DataFrame, x: str, y: str, bins: int = 100, sigma: float = 3.0
) -> DataFrame:
    """Adds ``density``: the blurred 2-D histogram at the cell of each point.

    The blur works on at most bins * bins cells, whatever the number of points.
    """
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    edges = _edges(rows, [x, y])
    placed = rows.withColumns({"_bx": _bin(x, edges, bins), "_by": _bin(y, edges, bins)})
    cells = placed.groupBy("_bx", "_by").agg(F.count(F.lit(1)).cast("double").alias("value"))
    smooth = _blur(_blur(cells, "_bx", "_by", bins, sigma), "_by", "_bx", bins, sigma)
    return placed.join(smooth.withColumnRenamed("value", "density"), ["_bx", "_by"]).drop("_bx", "_by")


def quartiles_by(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact quartiles of ``value`` per group."""
    rows = df.filter(F.col(group).isNotNull()).select(group, value)
    return exact_quantiles(rows, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})


def keep_columns(df: DataFrame, no_nulls: bool = False, min_unique: int = 2, max_unique: int | None = None) -> list[str]:
    """Names of columns without nulls and with a number of distinct values in a range."""
    profile = distinct_counts(df).filter(F.col("unique_values") >= min_unique)
    if no_nulls:
        profile = profile.filter("nan_values = 0")
    if max_unique is not None:
        profile = profile.filter(F.col("unique_values") <= max_unique)
    wanted = {row["column"] for row in profile.select("column").collect()}  # one row per column
    return [c for c in df.columns if c in wanted]
