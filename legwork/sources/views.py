"""Views that present the given star-schema tables in the shapes the operators read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.session import even_parts

# Zones of the stand-in airports, by airport number modulo 5.
ZONES = [
    "America/New_York",
    "America/Chicago",
    "America/Denver",
    "America/Los_Angeles",
    "Pacific/Honolulu",
]
# Their winter offsets from UTC; the events lie in January.
WINTER_OFFSETS = [-5, -6, -7, -8, -10]
# Airports and airlines the stand-in legs use; the scope lists leave one of each out.
VIEW_AIRPORTS = [f"A{i}" for i in range(7)]
VIEW_SCOPE_AIRPORTS = [f"A{i}" for i in range(6)]
VIEW_AIRLINES = [f"C{i}" for i in range(5)]
VIEW_SCOPE_AIRLINES = [f"C{i}" for i in range(4)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(number: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), number.cast("int") + 1)


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport dimension, one row per nation, with zone and weather stations."""
    number = F.col("n_nationkey")
    columns = [
        F.concat(F.lit("A"), number).alias("iata_code"),
        _pick(number % 5, ZONES).alias("TZ"),
        F.when(number % 3 == 0, F.lit("large_airport")).otherwise(F.lit("medium_airport")).alias("type"),
        (number % 4 + 1).alias("num_runways"),
        F.when(number % 6 != 5, F.concat(F.lit("S"), number)).alias("airport_station"),
    ]
    for i in (1, 2, 3):
        columns += [
            F.concat(F.lit("S"), (number + i) % 7).alias(f"closest_station_{i}"),
            (((number * 7 + i * 11) % 4 + i) * 12_000.0).alias(f"closest_station_{i}_distance"),
        ]
    return table(spark, sf_dir, "nation").select(*columns)


def _case(number: str, values: list) -> str:
    branches = " ".join(f"WHEN {i} THEN {v!r}" for i, v in enumerate(values))
    return f"CASE {number} {branches} END"


def raw_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw on-time records (the 30 source columns and ``FlightID``), one per event.

    The user is the aircraft, ``k`` and ``value`` drive destination, length and
    delay. Every 50th leg is cancelled, every 97th diverted, every 211th lacks its
    arrival time, every 101st its tail number.
    """
    # a file of few row groups is read by few tasks, and the times of a leg cost much more than its reading
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", "props")
    # the count reads no column; with bounded parts the longest task does not grow with the table, and
    # parts that follow the time write into few monthly folders
    parts = max(even_parts(events, events.count()), spark.sparkContext.defaultParallelism)
    dealt = events.repartitionByRange(parts, "ts", "event_id")
    # ``k`` is read from the text once: a filter on the legs is not moved below the generator, where
    # it would read the text again in every term
    read = dealt.selectExpr(
        "event_id", "user_id", "ts", "value", "explode(array(cast(get_json_object(props, '$.k') as int))) AS k"
    )
    drawn = read.selectExpr(
        "event_id",
        "user_id",
        "k",
        "cast(floor(value) as int) - 30 AS late",
        "cast(date_trunc('MINUTE', ts) as timestamp_ntz) AS dep",
        "event_id % 50 = 0 AS cancelled",
        "event_id % 97 = 0 AND event_id % 50 <> 0 AS diverted",
        "cast(user_id % 7 as int) AS o",
        "k % 7 AS d",
    )
    east = f"({_case('d % 5', WINTER_OFFSETS)}) - ({_case('o % 5', WINTER_OFFSETS)})"
    timed = drawn.selectExpr(
        "*",
        "late + k % 21 - 10 AS late_arr",
        "greatest(late + k % 21 - 10, 0) AS arr_minutes",
        "60 + k AS planned",
        "NOT cancelled AND NOT diverted AS flown",
        f"dep + make_dt_interval(0, {east}, 60 + k) AS arr",
    )
    clocked = timed.selectExpr(
        "*",
        "dep + make_dt_interval(0, 0, late) AS dep_real",
        "arr + make_dt_interval(0, 0, late_arr) AS arr_real",
        "flown AND late_arr >= 15 AS explained",
    )
    return clocked.selectExpr(
        "event_id AS FlightID",
        "bigint(year(dep)) AS Year",
        "bigint(month(dep)) AS Month",
        "bigint(dayofmonth(dep)) AS DayofMonth",
        "bigint(weekday(dep) + 1) AS DayOfWeek",
        "string(date(dep)) AS FlightDate",
        "concat('C', string((user_id + if(event_id % 10 = 0, 1, 0)) % 5)) AS Reporting_Airline",
        "if(event_id % 101 <> 0, concat('N', string(user_id)), null) AS Tail_Number",
        "(user_id % 50) * 4 + k % 4 AS Flight_Number_Reporting_Airline",
        "concat('A', string(o)) AS Origin",
        "concat('A', string(d)) AS Dest",
        "bigint(hour(dep) * 100 + minute(dep)) AS CRSDepTime",
        "if(cancelled, null, double(hour(dep_real) * 100 + minute(dep_real))) AS DepTime",
        "if(cancelled, null, double(late)) AS DepDelay",
        "if(cancelled, null, double(greatest(late, 0))) AS DepDelayMinutes",
        "bigint(hour(arr) * 100 + minute(arr)) AS CRSArrTime",
        "if(flown AND event_id % 211 <> 0, double(hour(arr_real) * 100 + minute(arr_real)), null) AS ArrTime",
        "if(flown, double(late_arr), null) AS ArrDelay",
        "if(flown, double(arr_minutes), null) AS ArrDelayMinutes",
        "double(int(cancelled)) AS Cancelled",
        "double(int(diverted)) AS Diverted",
        "double(planned) AS CRSElapsedTime",
        "if(flown, double(planned + late_arr - late), null) AS ActualElapsedTime",
        "if(flown, double(planned - 25), null) AS AirTime",
        "double(100 + k * 10) AS Distance",
        "bigint(k div 25 + 1) AS DistanceGroup",
        "if(explained, double(arr_minutes - arr_minutes div 2), null) AS CarrierDelay",
        "if(explained, double(if(k % 3 = 0, arr_minutes div 4, 0)), null) AS WeatherDelay",
        "if(explained, double(if(k % 3 = 1, arr_minutes div 5, 0)), null) AS NASDelay",
        "if(explained, 0D, null) AS SecurityDelay",
        "if(explained, double(if(k % 3 = 2, arr_minutes div 3, 0)), null) AS LateAircraftDelay",
    )


def station_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly readings per weather station (``S0``..``S6``); many hours lack some parameter."""
    k = F.get_json_object("props", "$.k").cast("int")
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.concat(F.lit("S"), F.col("user_id") % 7).alias("station"),
            F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("timestamp"),
        )
        .agg(
            F.avg(F.floor("value").cast("int")).alias("temp"),
            F.avg(F.when(k % 4 == 0, k)).alias("prcp"),
            F.max(F.when(k % 5 != 0, k)).cast("double").alias("wspd"),
            F.min(F.when(F.col("event_id") % 7 == 0, k)).cast("double").alias("rhum"),
        )
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw follower edges: one row per event, user -> ``k``."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("src_id"), k.alias("target_id"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node attributes: one row per customer key, which leaves isolated nodes."""
    key = F.col("c_custkey")
    languages = ["EN", "DE", "FR", "ES", "NL", "OTHER"]
    return table(spark, sf_dir, "customer").select(
        key.alias("id"),
        F.when(key % 17 == 0, 1).otherwise(0).alias("dead_account"),
        _pick(F.col("c_nationkey") % 6, languages).alias("language"),
        F.when(F.col("c_acctbal") > 5000, 1).otherwise(0).alias("affiliate_status"),
        F.when(F.col("c_mktsegment") == "MACHINERY", 1).otherwise(0).alias("explicit_content"),
        F.floor(F.greatest(F.col("c_acctbal"), F.lit(0.0))).cast("bigint").alias("view_count"),
        (key * 37 % 2000).alias("account_lifetime"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message log: sender, receiver, epoch second."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("src"),
        k.alias("dst"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("unix_ts"),
    )


def with_datetime(log: DataFrame) -> DataFrame:
    """Adds ``datetime`` (UTC wall clock) from the epoch second."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return log.withColumn(
        "datetime", epoch + F.make_dt_interval(secs=F.col("unix_ts").cast("decimal(18,6)"))
    )


def scoring_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-class evaluation input: label quality, prediction by length, score."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return labels.join(documents, "doc_id").select(
        "doc_id",
        "lang",
        F.col("quality").alias("label"),
        F.when((F.col("n_chars") >= 300) & (F.col("n_chars") <= 6000), 1).otherwise(0).alias("prediction"),
        F.col("n_chars").alias("score"),
    )


__all__ = [
    "airports", "edges", "messages", "nodes", "raw_legs", "scoring_pairs",
    "station_weather", "table", "with_datetime",
]
