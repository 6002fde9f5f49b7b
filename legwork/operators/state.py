"""Hourly airport state: what has happened at an airport so far on a day."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwork.functions.scalars import ratio, same
from legwork.functions.times import ceil_hour, floor_hour, interval, plus_minutes

STATE_KEYS = ["airport", "day", "hour"]


def hourly_counts(
    legs: DataFrame,
    airport: Column,
    day: Column,
    moment: Column,
    values: Sequence[str],
    recorded: Sequence[str],
    min_year: int | None = None,
) -> DataFrame:
    """Movements and value sums per airport, day and the full hour after the movement.

    A leg without its ``recorded`` columns has not moved and is left out.
    """
    rows = legs.filter(same(F.col("Cancelled"), F.lit(0))).dropna(subset=list(recorded))
    if min_year is not None:
        rows = rows.filter(F.col("Year") >= min_year)
    rows = rows.select(
        airport.alias("airport"),
        day.alias("day"),
        ceil_hour(moment).alias("hour"),
        *[F.coalesce(F.col(v), F.lit(0.0)).alias(v) for v in values],
    )
    return (
        rows.groupBy(*STATE_KEYS)
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(v).alias(v) for v in values])
    )


def day_so_far(counts: DataFrame, values: Sequence[str], prefix: str) -> DataFrame:
    """Running count, sums and means of the day, and those of the last hour, per hour mark.

    An hour without movements repeats the running columns of the hour before it on
    the same day; the last-hour columns are repeated for one hour, then 0.
    """
    day = Window.partitionBy("airport", "day").orderBy("hour")
    so_far = day.rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(so_far)
    columns = {f"{prefix}_cum_count_sfd": total, f"{prefix}_count_fligts_lh": F.col("n")}
    for v in values:
        columns[f"{prefix}_cum_{v}_sfd"] = F.sum(v).over(so_far)
        columns[f"{prefix}_avg_{v}_sfd"] = ratio(F.sum(v).over(so_far), total)
        columns[f"{prefix}_avg_{v}_lh"] = ratio(F.col(v), F.col("n"))
    midnight = F.col("day").cast("timestamp_ntz")
    last = F.greatest(F.col("hour"), midnight + interval(hours=23))
    until = F.coalesce(F.lead("hour").over(day) - interval(hours=1), last)
    marks = counts.withColumns(columns).withColumn("_until", until)
    hours = F.sequence("hour", "_until", interval(hours=1))
    filled = marks.select("*", F.posexplode(hours).alias("_gap", "_mark"))
    keep = [c for c in columns if c.endswith("_sfd")]
    fade = [c for c in columns if c.endswith("_lh")]
    return filled.select(
        "airport",
        "day",
        F.col("_mark").alias("hour"),
        *keep,
        *[F.when(F.col("_gap") <= 1, F.col(c)).otherwise(0).alias(c) for c in fade],
    )


def departures_state(legs: DataFrame, min_year: int | None = None) -> DataFrame:
    """Departures from the airport."""
    values = ["DepDelayMinutes"]
    counts = hourly_counts(
        legs, F.col("Origin"), F.to_date("FlightDate"), F.col("DepDateTime"), values, ["DepTime"], min_year
    )
    return day_so_far(counts, values, "R_dep")


def arrivals_state(legs: DataFrame, min_year: int | None = None) -> DataFrame:
    """Arrivals at the airport, by the planned arrival day."""
    values = ["ArrDelayMinutes", "WeatherDelay", "NASDelay"]
    counts = hourly_counts(
        legs, F.col("Dest"), F.to_date("CRSArrDateTime"), F.col("ArrDateTime"), values, ["ArrTime"], min_year
    )
    return day_so_far(counts, values, "R_arr_origin")


def landed_elsewhere_state(legs: DataFrame, min_year: int | None = None) -> DataFrame:
    """Arrivals elsewhere of legs that left the airport, on the airport's own clock."""
    values = ["ArrDelayMinutes", "NASDelay"]
    moment = plus_minutes(F.col("DepDateTime"), F.col("ActualElapsedTime"))
    recorded = ["DepTime", "ActualElapsedTime"]
    counts = hourly_counts(legs, F.col("Origin"), F.to_date(moment), moment, values, recorded, min_year)
    return day_so_far(counts, values, "R_dest_arrived")


def airport_state(legs: DataFrame, min_year: int | None = None) -> DataFrame:
    """The three states side by side, one row per airport, day and hour mark."""
    parts = [
        departures_state(legs, min_year),
        arrivals_state(legs, min_year),
        landed_elsewhere_state(legs, min_year),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    columns = [c for c in stacked.columns if c not in STATE_KEYS]
    return stacked.groupBy(*STATE_KEYS).agg(*[F.max(c).alias(c) for c in columns])


def attach_state(legs: DataFrame, state: DataFrame) -> DataFrame:
    """Joins the state at the last full hour before the information time; none counts 0.

    A leg that departs before 02:00 looks back into the previous calendar day, for which
    its own day has no state, and gets 0.
    """
    columns = [c for c in state.columns if c not in STATE_KEYS]
    lookup = state.select(
        F.col("airport").alias("Origin"),
        F.date_format("day", "yyyy-MM-dd").alias("FlightDate"),
        F.col("hour").alias("floor_informationtime"),
        *columns,
    )
    keys = ["Origin", "FlightDate", "floor_informationtime"]
    return legs.join(lookup, keys, "left").fillna(0, subset=columns)


def cancelled_so_far(legs: DataFrame) -> DataFrame:
    """Running cancellations, departures and mean delay per airport, day and hour mark.

    Cancelled legs have no departure time and count from the start of the day.
    """
    day = F.to_date("FlightDate")
    counts = legs.select(
        F.col("Origin").alias("airport"),
        day.alias("day"),
        F.coalesce(ceil_hour(F.col("DepDateTime")), day.cast("timestamp_ntz")).alias("hour"),
        F.col("Cancelled").cast("int").alias("cancelled"),
        F.coalesce(F.col("DepDelayMinutes"), F.lit(0.0)).alias("late"),
    ).groupBy(*STATE_KEYS).agg(
        F.sum("cancelled").alias("cancelled"),
        F.sum(1 - F.col("cancelled")).alias("departed"),
        F.sum("late").alias("late"),
    )
    so_far = Window.partitionBy("airport", "day").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    return counts.select(
        *STATE_KEYS,
        F.sum("cancelled").over(so_far).alias("cum_cancelled"),
        F.sum("departed").over(so_far).alias("cum_count"),
        ratio(F.sum("late").over(so_far), F.sum("departed").over(so_far)).alias("avg_delay"),
        F.col("departed").alias("flights_in_last_hour"),
    )


def mean_before_cutoff(legs: DataFrame, hours_before: int = 2) -> DataFrame:
    """Mean departure delay of legs planned at the same airport and day up to the cutoff.

    Legs are first summed per planned minute, so the range frame runs over at most
    1440 rows per airport and day; legs of one minute share the answer.
    """
    keys = ["Origin", "FlightDate", "CRSDepDateTime"]
    minutes = legs.groupBy(*keys).agg(F.sum("DepDelay").alias("_s"), F.count("DepDelay").alias("_n"))
    epoch = F.unix_seconds(F.col("CRSDepDateTime").cast("timestamp"))
    window = (
        Window.partitionBy("Origin", "FlightDate")
        .orderBy(epoch)
        .rangeBetween(Window.unboundedPreceding, -3600 * hours_before)
    )
    known = minutes.select(
        *keys,
        F.coalesce(ratio(F.sum("_s").over(window), F.sum("_n").over(window)), F.lit(0.0)).alias(
            "AvgDelaySameDaySameAirport"
        ),
    )
    return legs.join(known, keys, "left")


def hour_spine(df: DataFrame, key: str, ts: str, name: str = "hour") -> DataFrame:
    """Every key of ``df`` with every hour between the first and last hour of the table."""
    hour = floor_hour(F.col(ts))
    span = df.agg(F.struct(F.min(hour).alias("lo"), F.max(hour).alias("hi"))).scalar()
    keys = df.filter(F.col(key).isNotNull()).select(key).distinct()
    return keys.select(key, F.explode(F.sequence(span["lo"], span["hi"], interval(hours=1))).alias(name))


def forward_fill(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], limit: int | None = None
) -> DataFrame:
    """Last known value of the rows before, at most ``limit`` rows back."""
    start = Window.unboundedPreceding if limit is None else -limit
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(start, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in columns})
