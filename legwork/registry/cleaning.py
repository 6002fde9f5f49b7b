"""Scans, filters, time parsing, target classes."""

from pyspark.sql import functions as F

from legwork.functions import scalars as s
from legwork.functions import times as t
from legwork.operators import clean, target
from legwork.registry.base import TS, day_text, fresh_legs, legs, query, raw, sql, text
from legwork.sources import views


@query("scope_filter", sql(["raw"], """
SELECT FlightID, Reporting_Airline, Origin, Dest FROM raw
WHERE Reporting_Airline IN ('C0','C1','C2','C3')
  AND (Origin IN ('A0','A1','A2','A3','A4','A5') OR Dest IN ('A0','A1','A2','A3','A4','A5'))"""))
def scope_filter(spark, d):
    kept = clean.in_scope(raw(spark, d), views.VIEW_SCOPE_AIRLINES, views.VIEW_SCOPE_AIRPORTS)
    return kept.select("FlightID", "Reporting_Airline", "Origin", "Dest")


@query("anomaly_filter", sql(["raw"], """
SELECT FlightID, Cancelled, Diverted, ArrTime FROM raw
WHERE NOT (ArrTime IS NULL AND Cancelled = 0 AND Diverted = 0)"""))
def anomaly_filter(spark, d):
    return clean.drop_lost_legs(raw(spark, d)).select("FlightID", "Cancelled", "Diverted", "ArrTime")


@query("hhmm_parse", sql(["clean0"], """
SELECT FlightID, CAST(CRSDepTime AS INTEGER) AS crs_dep, CAST(DepTime AS DOUBLE) AS dep,
  CAST(CRSArrTime AS INTEGER) AS crs_arr, CAST(ArrTime AS DOUBLE) AS arr,
  lpad(CAST(DepTime // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(DepTime % 60 AS VARCHAR), 2, '0') AS dep_clock
FROM clean0"""))
def hhmm_parse(spark, d):
    parsed = clean.parse_clock_times(clean.drop_lost_legs(raw(spark, d)))
    return parsed.select(
        "FlightID",
        F.col("CRSDepTime").alias("crs_dep"), F.col("DepTime").cast("double").alias("dep"),
        F.col("CRSArrTime").alias("crs_arr"), F.col("ArrTime").cast("double").alias("arr"),
        t.clock_text(F.col("DepTime")).alias("dep_clock"),
    )


@query("local_to_utc", sql(["legs"], f"""
SELECT FlightID, strftime(CRSDepDateTime_UTC, {TS}) AS crs_dep_utc, strftime(DepDateTime_UTC, {TS}) AS dep_utc,
  strftime(CRSArrDateTime_UTC, {TS}) AS crs_arr_utc, strftime(ArrDateTime_UTC, {TS}) AS arr_utc,
  strftime(DepDateTime, {TS}) AS dep_local, strftime(ArrDateTime, {TS}) AS arr_local,
  strftime(UTC_CRS_FlightDate, '%Y-%m-%d') AS utc_day
FROM legs"""))
def local_to_utc(spark, d):
    return fresh_legs(spark, d).select(
        "FlightID",
        text("CRSDepDateTime_UTC").alias("crs_dep_utc"), text("DepDateTime_UTC").alias("dep_utc"),
        text("CRSArrDateTime_UTC").alias("crs_arr_utc"), text("ArrDateTime_UTC").alias("arr_utc"),
        text("DepDateTime").alias("dep_local"), text("ArrDateTime").alias("arr_local"),
        day_text("UTC_CRS_FlightDate").alias("utc_day"),
    )


@query("info_hour", sql(["legs"], f"""
SELECT FlightID, strftime(Information_time_UTC, {TS}) AS info_utc, strftime(floor_informationtime_UTC, {TS}) AS hour_utc,
  strftime(Information_time, {TS}) AS info_local, strftime(floor_informationtime, {TS}) AS hour_local,
  CAST(hour(CRSDepDateTime) * 60 + minute(CRSDepDateTime) AS INTEGER) AS dep_minute,
  CAST(dayofyear(CRSDepDateTime) AS INTEGER) AS day_of_year, CAST(hour(CRSDepDateTime) AS INTEGER) AS dep_hour
FROM legs"""))
def info_hour(spark, d):
    return fresh_legs(spark, d).select(
        "FlightID",
        text("Information_time_UTC").alias("info_utc"), text("floor_informationtime_UTC").alias("hour_utc"),
        text("Information_time").alias("info_local"), text("floor_informationtime").alias("hour_local"),
        t.minute_of_day(F.col("CRSDepDateTime")).alias("dep_minute"),
        F.dayofyear("CRSDepDateTime").alias("day_of_year"), F.hour("CRSDepDateTime").alias("dep_hour"),
    )


@query("ceil_hour", sql(["ev"], f"""
SELECT event_id, strftime(CASE WHEN date_trunc('hour', ts) = ts THEN ts ELSE date_trunc('hour', ts) + to_hours(1) END, {TS}) AS hour_mark,
  CASE WHEN date_trunc('minute', ts) = ts THEN 1 ELSE 0 END AS on_minute,
  round(date_diff('second', date_trunc('day', ts), date_trunc('second', ts)) / 60.0, 6) AS minutes_of_day
FROM ev"""))
def ceil_hour(spark, d):
    events = views.table(spark, d, "events")
    start = F.date_trunc("DAY", "ts").cast("timestamp_ntz")
    second = F.date_trunc("SECOND", "ts").cast("timestamp_ntz")
    return events.select(
        "event_id",
        text(t.ceil_hour(F.col("ts"))).alias("hour_mark"),
        s.flag(F.date_trunc("MINUTE", "ts").cast("timestamp_ntz") == F.col("ts")).alias("on_minute"),
        F.round(t.minutes_between(start, second), 6).alias("minutes_of_day"),
    )


@query("delay_class", sql(["legs"], """
SELECT FlightID, ArrDelayMinutes,
  CASE WHEN ArrDelayMinutes <= 15 THEN 'no_delay' WHEN ArrDelayMinutes <= 60 THEN 'small_delay'
       WHEN ArrDelayMinutes <= 180 THEN 'medium_delay' ELSE 'large_delay' END AS delay_class,
  CASE WHEN ArrDelayMinutes <= 15 THEN 0 WHEN ArrDelayMinutes <= 60 THEN 1 WHEN ArrDelayMinutes <= 180 THEN 2 ELSE 3 END AS ordinal
FROM legs WHERE ArrDelayMinutes IS NOT NULL"""))
def delay_class(spark, d):
    labelled = target.add_delay_class(legs(spark, d))
    return labelled.select(
        "FlightID", "ArrDelayMinutes", "delay_class", s.class_ordinal(F.col("delay_class")).alias("ordinal")
    )


@query("class_balance", sql(["legs"], """
SELECT c.label AS delay_class, c.ordinal, CAST(count(FlightID) AS BIGINT) AS rows,
  round(count(FlightID) / (SELECT count(*) FROM legs WHERE ArrDelayMinutes IS NOT NULL), 6) AS share,
  round(count(FlightID) * 0.15, 6) AS expected_in_test
FROM (VALUES ('no_delay', 0), ('small_delay', 1), ('medium_delay', 2), ('large_delay', 3)) c(label, ordinal)
LEFT JOIN legs ON ArrDelayMinutes IS NOT NULL AND c.ordinal = CASE WHEN ArrDelayMinutes <= 15 THEN 0
  WHEN ArrDelayMinutes <= 60 THEN 1 WHEN ArrDelayMinutes <= 180 THEN 2 ELSE 3 END
GROUP BY ALL"""))
def class_balance(spark, d):
    return target.class_balance(target.add_delay_class(legs(spark, d)))


@query("training_rows", sql(["train"], """
SELECT FlightID, Origin, Dest, CRSElapsedTime, Reporting_Airline || CAST(Flight_Number_Reporting_Airline AS VARCHAR) AS full_flight_number
FROM train"""))
def training_rows(spark, d):
    kept = clean.training_rows(legs(spark, d), views.VIEW_SCOPE_AIRPORTS, min_year=2014)
    return kept.select(
        "FlightID", "Origin", "Dest", "CRSElapsedTime",
        F.concat("Reporting_Airline", F.col("Flight_Number_Reporting_Airline").cast("string")).alias("full_flight_number"),
    )


@query("zone_join_guard", sql(["raw", "airport_dim"], """
SELECT role, iata_code, CAST(count(*) AS BIGINT) AS legs FROM (
  SELECT 'Origin' AS role, Origin AS iata_code FROM raw UNION ALL SELECT 'Dest', Dest FROM raw) u
WHERE NOT EXISTS (SELECT 1 FROM airport_dim a WHERE a.iata_code = u.iata_code AND a.iata_code NOT IN ('A3', 'A5'))
GROUP BY ALL"""))
def zone_join_guard(spark, d):
    known = views.airports(spark, d).filter(~F.col("iata_code").isin("A3", "A5"))
    return clean.missing_zones(raw(spark, d), known)
