"""Registration helpers and the SQL forms of the views."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.operators import clean
from legwork.session import apply_defaults, shared_dir
from legwork.sources import sinks, views
from legwork.sources.tables import path_exists


class Entry(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of (spark, sf_dir) under ``name``."""

    def register(run):
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(apply_defaults(spark), sf_dir)

        ENTRIES[name] = Entry(prepared, sql)
        return run

    return register


def text(ts: Column | str) -> Column:
    """Timestamp as text, the form in which results leave a query."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def day_text(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def rounded(*names: str, digits: int = 6) -> list[Column]:
    """Columns as doubles of so many digits; rounding goes through a decimal, which whole numbers are spared."""
    found = []
    for n in names:
        number = F.col(n).cast("double")
        whole = (F.rint(number) == number) if digits >= 0 else F.lit(False)
        found.append(F.when(whole, number + 0.0).otherwise(F.round(number, digits)).alias(n))
    return found


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.raw_legs(spark, sf_dir)


def staged(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], gathered: bool = False
) -> DataFrame:
    """A table of year and month folders in the shared folder, built on first use in a session."""
    source = hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/legwork/{app}/{source}/{name}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        sinks.write_legs(build(), path, gathered)
    return sinks.read_legs(spark, path)


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned legs, read from the table that the cleaning job writes."""
    return staged(spark, sf_dir, "clean_legs", lambda: fresh_legs(spark, sf_dir), gathered=True)


def fresh_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned legs straight from the events table."""
    return clean.clean_legs(raw(spark, sf_dir), views.airports(spark, sf_dir))


# --- SQL forms ----------------------------------------------------------------------
TS = "'%Y-%m-%d %H:%M:%S'"

_ZONE = (
    "CASE {n} % 5 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago' "
    "WHEN 2 THEN 'America/Denver' WHEN 3 THEN 'America/Los_Angeles' ELSE 'Pacific/Honolulu' END"
)

_OFFSET = "CASE {n} WHEN 0 THEN -5 WHEN 1 THEN -6 WHEN 2 THEN -7 WHEN 3 THEN -8 ELSE -10 END"


def _hhmm(ts: str) -> str:
    return f"(hour({ts}) * 100 + minute({ts}))"


def _minutes(column: str) -> str:
    number = f"CAST({column} AS BIGINT)"
    return (
        f"CASE WHEN {number} = 2400 THEN 0 WHEN {number} >= 0 AND {number} // 100 < 24 "
        f"AND {number} % 100 < 60 THEN ({number} // 100) * 60 + {number} % 100 END"
    )


CTES = {
    "ev": """
SELECT event_id, user_id, ts, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events""",
    "airport_dim": f"""
SELECT 'A' || n_nationkey AS iata_code, {_ZONE.format(n='n_nationkey')} AS TZ,
  CASE WHEN n_nationkey % 6 <> 5 THEN 'S' || n_nationkey END AS airport_station,
  'S' || ((n_nationkey + 1) % 7) AS closest_station_1, ((n_nationkey * 7 + 11) % 4 + 1) * 12000.0 AS closest_station_1_distance,
  'S' || ((n_nationkey + 2) % 7) AS closest_station_2, ((n_nationkey * 7 + 22) % 4 + 2) * 12000.0 AS closest_station_2_distance,
  'S' || ((n_nationkey + 3) % 7) AS closest_station_3, ((n_nationkey * 7 + 33) % 4 + 3) * 12000.0 AS closest_station_3_distance
FROM nation""",
    "raw0": """
SELECT event_id, user_id, k, CAST(floor(value) AS INTEGER) - 30 AS late, date_trunc('minute', ts) AS dep,
  event_id % 50 = 0 AS cancelled, event_id % 97 = 0 AND event_id % 50 <> 0 AS diverted,
  event_id % 211 = 0 AS lost, event_id % 101 = 0 AS no_tail,
  (user_id + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END) % 5 AS carrier,
  user_id % 7 AS o, k % 7 AS d
FROM ev""",
    "raw1": f"""
SELECT *, late + k % 21 - 10 AS late_arr, 60 + k AS planned, NOT cancelled AND NOT diverted AS flown,
  dep + to_minutes(60 + k) + to_hours({_OFFSET.format(n='(d % 5)')} - {_OFFSET.format(n='(o % 5)')}) AS arr
FROM raw0""",
    "raw": f"""
SELECT event_id AS FlightID, CAST(year(dep) AS BIGINT) AS "Year", CAST(month(dep) AS BIGINT) AS "Month",
  CAST(day(dep) AS BIGINT) AS DayofMonth, CAST(isodow(dep) AS BIGINT) AS DayOfWeek,
  strftime(dep, '%Y-%m-%d') AS FlightDate, 'C' || carrier AS Reporting_Airline,
  CASE WHEN NOT no_tail THEN 'N' || user_id END AS Tail_Number,
  (user_id % 50) * 4 + k % 4 AS Flight_Number_Reporting_Airline,
  'A' || o AS Origin, 'A' || d AS Dest,
  CAST({_hhmm('dep')} AS BIGINT) AS CRSDepTime,
  CASE WHEN NOT cancelled THEN CAST({_hhmm('(dep + to_minutes(late))')} AS DOUBLE) END AS DepTime,
  CASE WHEN NOT cancelled THEN CAST(late AS DOUBLE) END AS DepDelay,
  CASE WHEN NOT cancelled THEN CAST(greatest(late, 0) AS DOUBLE) END AS DepDelayMinutes,
  CAST({_hhmm('arr')} AS BIGINT) AS CRSArrTime,
  CASE WHEN flown AND NOT lost THEN CAST({_hhmm('(arr + to_minutes(late_arr))')} AS DOUBLE) END AS ArrTime,
  CASE WHEN flown THEN CAST(late_arr AS DOUBLE) END AS ArrDelay,
  CASE WHEN flown THEN CAST(greatest(late_arr, 0) AS DOUBLE) END AS ArrDelayMinutes,
  CAST(cancelled AS DOUBLE) AS Cancelled, CAST(diverted AS DOUBLE) AS Diverted,
  CAST(planned AS DOUBLE) AS CRSElapsedTime,
  CASE WHEN flown THEN CAST(planned + late_arr - late AS DOUBLE) END AS ActualElapsedTime,
  CASE WHEN flown THEN CAST(planned - 25 AS DOUBLE) END AS AirTime,
  CAST(100 + k * 10 AS DOUBLE) AS Distance, CAST(k // 25 + 1 AS BIGINT) AS DistanceGroup,
  CASE WHEN flown AND late_arr >= 15 THEN CAST(greatest(late_arr, 0) - greatest(late_arr, 0) // 2 AS DOUBLE) END AS CarrierDelay,
  CASE WHEN flown AND late_arr >= 15 THEN CAST(CASE WHEN k % 3 = 0 THEN greatest(late_arr, 0) // 4 ELSE 0 END AS DOUBLE) END AS WeatherDelay,
  CASE WHEN flown AND late_arr >= 15 THEN CAST(CASE WHEN k % 3 = 1 THEN greatest(late_arr, 0) // 5 ELSE 0 END AS DOUBLE) END AS NASDelay,
  CASE WHEN flown AND late_arr >= 15 THEN CAST(0 AS DOUBLE) END AS SecurityDelay,
  CASE WHEN flown AND late_arr >= 15 THEN CAST(CASE WHEN k % 3 = 2 THEN greatest(late_arr, 0) // 3 ELSE 0 END AS DOUBLE) END AS LateAircraftDelay
FROM raw1""",
    "clean0": f"""
SELECT r.* EXCLUDE (CRSDepTime, DepTime, CRSArrTime, ArrTime),
  {_minutes('CRSDepTime')} AS CRSDepTime, {_minutes('DepTime')} AS DepTime, {_minutes('CRSArrTime')} AS CRSArrTime,
  CASE WHEN Diverted <> 1 THEN {_minutes('ArrTime')} END AS ArrTime,
  a.TZ AS TZ_Origin, b.TZ AS TZ_Dest
FROM raw r LEFT JOIN airport_dim a ON a.iata_code = Origin LEFT JOIN airport_dim b ON b.iata_code = Dest
WHERE NOT (ArrTime IS NULL AND Cancelled = 0 AND Diverted = 0)""",
    "clean1": """
SELECT *, CAST(FlightDate AS TIMESTAMP) + to_minutes(CRSDepTime) AS CRSDepDateTime,
  CAST(FlightDate AS TIMESTAMP) + to_minutes(CRSArrTime) AS arr_plan,
  CAST(FlightDate AS TIMESTAMP) + to_minutes(DepTime)
    + to_days(CASE WHEN DepTime < CRSDepTime AND DepDelay > 0 THEN 1 ELSE 0 END) AS DepDateTime,
  CAST(FlightDate AS TIMESTAMP) + to_minutes(ArrTime) AS arr_real
FROM clean0""",
    "clean2": """
SELECT *, (CRSDepDateTime AT TIME ZONE TZ_Origin) AT TIME ZONE 'UTC' AS CRSDepDateTime_UTC,
  (DepDateTime AT TIME ZONE TZ_Origin) AT TIME ZONE 'UTC' AS DepDateTime_UTC,
  (arr_plan AT TIME ZONE TZ_Dest) AT TIME ZONE 'UTC' AS arr_plan_utc,
  (arr_real AT TIME ZONE TZ_Dest) AT TIME ZONE 'UTC' AS arr_real_utc
FROM clean1""",
    "legs": """
SELECT * EXCLUDE (arr_plan, arr_real, arr_plan_utc, arr_real_utc),
  CASE WHEN arr_plan_utc < CRSDepDateTime_UTC THEN arr_plan + to_days(1) ELSE arr_plan END AS CRSArrDateTime,
  CASE WHEN arr_plan_utc < CRSDepDateTime_UTC THEN arr_plan_utc + to_days(1) ELSE arr_plan_utc END AS CRSArrDateTime_UTC,
  CASE WHEN arr_real_utc < DepDateTime_UTC THEN arr_real + to_days(1) ELSE arr_real END AS ArrDateTime,
  CASE WHEN arr_real_utc < DepDateTime_UTC THEN arr_real_utc + to_days(1) ELSE arr_real_utc END AS ArrDateTime_UTC,
  CAST(CRSDepDateTime_UTC AS DATE) AS UTC_CRS_FlightDate,
  CRSDepDateTime_UTC - to_hours(2) AS Information_time_UTC, CRSDepDateTime - to_hours(2) AS Information_time,
  date_trunc('hour', CRSDepDateTime_UTC - to_hours(2)) AS floor_informationtime_UTC,
  date_trunc('hour', CRSDepDateTime - to_hours(2)) AS floor_informationtime
FROM clean2""",
    "train": """
SELECT * FROM legs WHERE CRSElapsedTime IS NOT NULL AND Origin IN ('A0','A1','A2','A3','A4','A5')
  AND Dest IN ('A0','A1','A2','A3','A4','A5') AND Cancelled <> 1 AND Diverted <> 1""",
}
NEEDS = {
    "ev": [], "airport_dim": [], "raw0": ["ev"], "raw1": ["raw0"], "raw": ["raw1"],
    "clean0": ["raw", "airport_dim"], "clean1": ["clean0"], "clean2": ["clean1"],
    "legs": ["clean2"], "train": ["legs"],
}


def cte(name: str, body: str, needs: list[str] = ()) -> None:
    """Adds a shared SQL building block."""
    CTES[name] = "\n" + body.strip()
    NEEDS[name] = list(needs)


def sql(uses: list[str], body: str, **local: str) -> str:
    """A statement with the named shared blocks, then local ones, before ``body``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for need in NEEDS[name]:
                add(need)
            ordered.append(name)

    for name in uses:
        add(name)
    parts = [f"{n} AS ({CTES[n]}\n)" for n in ordered]
    parts += [f"{n} AS (\n{b.strip()}\n)" for n, b in local.items()]
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return head + body.strip()
