"""Hourly weather: fallback stations, gap fill and the join to legs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwork.functions.times import interval
from legwork.operators.state import forward_fill
from legwork.schemas import MAX_STATION_DISTANCE_M, WEATHER_PARAMS
from legwork.session import cut_to_table


def station_columns(airports: DataFrame, first: str = "airport_station") -> DataFrame:
    """The airport code and every column from ``first`` to the end."""
    start = airports.columns.index(first)
    return airports.select("iata_code", *airports.columns[start:])


def airport_spans(legs: DataFrame, margin_hours: int = 5) -> DataFrame:
    """First and last hour an airport is asked for, in either role, widened by a margin."""
    hour = "floor_informationtime_UTC"

    def span(role: str, tag: str) -> DataFrame:
        return legs.groupBy(F.col(role).alias("airport")).agg(
            F.min(hour).alias(f"lo_{tag}"), F.max(hour).alias(f"hi_{tag}")
        )

    both = span("Origin", "o").join(span("Dest", "d"), "airport", "full")
    margin = interval(hours=margin_hours)
    return both.select(
        "airport",
        (F.least("lo_o", "lo_d") - margin).alias("first_hour"),
        (F.greatest("hi_o", "hi_d") + margin).alias("last_hour"),
    )


def station_choices(airports: DataFrame, max_distance: float = MAX_STATION_DISTANCE_M) -> DataFrame:
    """Stations an airport may use, best first; the airport's own station has rank 0."""
    options = [F.struct(F.lit(0).alias("rank"), F.col("airport_station").alias("station"))]
    for i in (1, 2, 3):
        near = F.col(f"closest_station_{i}_distance") < max_distance
        options.append(
            F.struct(F.lit(i).alias("rank"), F.when(near, F.col(f"closest_station_{i}")).alias("station"))
        )
    listed = airports.select(F.col("iata_code").alias("airport"), F.inline(F.array(*options)))
    return listed.filter(F.col("station").isNotNull())


def airport_readings(airports: DataFrame, readings: DataFrame) -> DataFrame:
    """One value per airport, hour and parameter from the best station that has it."""
    choices = station_choices(airports)
    return (
        readings.join(choices, "station")
        .groupBy("airport", "timestamp")
        .agg(
            *[
                F.min_by(p, F.when(F.col(p).isNotNull(), F.col("rank"))).alias(p)
                for p in WEATHER_PARAMS
            ]
        )
    )


def complete_hours(spans: DataFrame, series: DataFrame, keep: int = 2) -> DataFrame:
    """Every hour of every span; gaps take the last value up to ``keep`` hours back, then 0."""
    return fill_gaps(spine_with_readings(spans, series), keep)


def spine_with_readings(spans: DataFrame, series: DataFrame) -> DataFrame:
    hours = spans.select(
        "airport", F.explode(F.sequence("first_hour", "last_hour", interval(hours=1))).alias("timestamp")
    )
    return hours.join(series, ["airport", "timestamp"], "left")


def fill_gaps(series: DataFrame, keep: int = 2) -> DataFrame:
    filled = forward_fill(series, ["airport"], "timestamp", WEATHER_PARAMS, keep)
    return filled.fillna(0.0, subset=WEATHER_PARAMS)


def missing_share(series: DataFrame, keep: int = 2, limit: float = 0.5) -> DataFrame:
    """Share of hours without a value per airport and parameter, flagged above ``limit``."""
    filled = forward_fill(series, ["airport"], "timestamp", WEATHER_PARAMS, keep)
    shares = filled.groupBy("airport").agg(
        *[F.avg(F.col(p).isNull().cast("int")).alias(p) for p in WEATHER_PARAMS]
    )
    long = shares.unpivot("airport", WEATHER_PARAMS, "parameter", "missing_share")
    return long.withColumn("warn", (F.col("missing_share") > limit).cast("int"))


def airport_weather(legs: DataFrame, airports: DataFrame, readings: DataFrame) -> DataFrame:
    """The completed hourly series of every airport the legs use and the dimension knows."""
    known = airports.select(F.col("iata_code").alias("airport"))
    spans = airport_spans(legs).join(known, "airport")
    return complete_hours(spans, airport_readings(airports, readings))


def _at(weather: DataFrame, end: str, suffix: str) -> DataFrame:
    return weather.select(
        F.col("airport").alias(end),
        F.col("timestamp").alias("floor_informationtime_UTC"),
        *[F.col(p).alias(f"{p}_{suffix}") for p in WEATHER_PARAMS],
    )


def attach_weather(legs: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather at both ends at information time; legs without either are removed."""
    hour = "floor_informationtime_UTC"
    return legs.join(_at(weather, "Origin", "DEP"), ["Origin", hour]).join(
        _at(weather, "Dest", "ARR"), ["Dest", hour]
    )


def unmatched_legs(legs: DataFrame, weather: DataFrame) -> DataFrame:
    """Legs whose weather is missing at one end or the other, each once.

    The hours that have weather are written first, so Spark knows how few they are, and the legs
    are not shuffled for them; only the legs found are.
    """
    hour = "floor_informationtime_UTC"
    known = cut_to_table(weather.select("airport", F.col("timestamp").alias(hour)).distinct(), "weather-hours")
    marked = legs
    for end in ("Origin", "Dest"):
        at_end = known.select(F.col("airport").alias(end), hour, F.lit(True).alias(f"_at_{end}"))
        marked = marked.join(at_end, [end, hour], "left")
    missing = F.col("_at_Origin").isNull() | F.col("_at_Dest").isNull()
    return marked.filter(missing).select(legs.columns).distinct()
