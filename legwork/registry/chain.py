"""Previous leg of the aircraft."""

from pyspark.sql import functions as F

from legwork.operators import chain
from legwork.registry.base import cte, legs, query, rounded, sql, text

cte("linked", """
SELECT *, same_air AND pc = 0 AND pd = 0 AND Origin = p_dest AS has,
  CASE WHEN same_air AND pc = 0 AND pd = 0 AND Origin = p_dest
    THEN date_diff('second', p_crs_arr, CRSDepDateTime_UTC) / 60.0 END AS turn
FROM (SELECT *, coalesce(Tail_Number IS NOT NULL AND Reporting_Airline = p_air, false) AS same_air FROM (
  SELECT *, lag(FlightID) OVER w AS p_id, lag(Dest) OVER w AS p_dest, lag(Origin) OVER w AS p_orig, lag(FlightDate) OVER w AS p_day,
    lag(Reporting_Airline) OVER w AS p_air, lag(Cancelled) OVER w AS pc, lag(Diverted) OVER w AS pd,
    lag(CRSArrDateTime_UTC) OVER w AS p_crs_arr, lag(ArrDateTime_UTC) OVER w AS p_arr,
    lag(CRSDepDateTime_UTC) OVER w AS p_crs_dep, lag(DepDateTime_UTC) OVER w AS p_dep,
    lag(DepDelayMinutes) OVER w AS p_dd, lag(ArrDelayMinutes) OVER w AS p_ad,
    lag(LateAircraftDelay) OVER w AS p_late, lag(WeatherDelay) OVER w AS p_weather, lag(NASDelay) OVER w AS p_nas, lag(CarrierDelay) OVER w AS p_carrier
  FROM legs WHERE Tail_Number IS NOT NULL WINDOW w AS (PARTITION BY Tail_Number ORDER BY CRSDepDateTime_UTC, FlightID)
  UNION ALL BY NAME SELECT * FROM legs WHERE Tail_Number IS NULL))""", ["legs"])
cte("known", """
SELECT *, coalesce(has AND Information_time_UTC >= p_crs_dep, false) AS due_out, coalesce(has AND Information_time_UTC >= p_dep, false) AS is_out,
  coalesce(has AND Information_time_UTC >= p_crs_arr, false) AS due_in, coalesce(has AND Information_time_UTC >= p_arr, false) AS landed,
  coalesce(turn, (SELECT avg(turn) FROM linked)) AS crs_turn
FROM linked""", ["linked"])
cte("known2", """
SELECT *, CASE WHEN due_in AND NOT landed THEN date_diff('second', p_crs_arr, Information_time_UTC) / 60.0
  WHEN landed THEN p_ad WHEN due_out AND NOT is_out THEN date_diff('second', p_crs_dep, Information_time_UTC) / 60.0
  WHEN is_out THEN p_dd ELSE 0 END AS known_delay FROM known""", ["known"])


def linked_columns(spark, d):
    """The columns that the chain reads; it stores the rows it links."""
    return legs(spark, d).select("Tail_Number", "Information_time_UTC", *chain.PREVIOUS_FIELDS)


@query("prev_leg_chain", sql(["linked"], f"""
SELECT FlightID, CAST(p_id AS DOUBLE) AS prev_id, strftime(p_crs_arr, '%Y-%m-%d %H:%M:%S') AS prev_crs_arr,
  CASE WHEN same_air THEN 0 ELSE 1 END AS FirstFlightRecord, CASE WHEN has THEN 1 ELSE 0 END AS has_prev_flight,
  CASE WHEN p_day = FlightDate THEN 1 ELSE 0 END AS Same_day_previous_flight,
  CASE WHEN Origin = p_dest AND Dest = p_orig THEN 1 ELSE 0 END AS is_Return_flight
FROM linked"""))
def prev_leg_chain(spark, d):
    linked = chain.add_previous_leg(legs(spark, d))
    return linked.select(
        "FlightID", F.col("prev.FlightID").cast("double").alias("prev_id"),
        text("prev.CRSArrDateTime_UTC").alias("prev_crs_arr"),
        "FirstFlightRecord", "has_prev_flight", "Same_day_previous_flight", "is_Return_flight",
    )


@query("prev_leg_known_delay", sql(["known2"], """
SELECT FlightID, round(known_delay, 6) AS Prev_flight_DelayMinutes, CASE WHEN is_out THEN 1 ELSE 0 END AS Prev_flight_has_departed,
  CASE WHEN has IS NOT TRUE THEN 0.5 WHEN landed THEN 1.0 ELSE 0.0 END::DOUBLE AS Airplane_already_at_airport,
  round(crs_turn - known_delay, 6) AS Expected_Tournaround_time,
  CASE WHEN landed THEN coalesce(p_late, 0) ELSE 0 END AS LateAircraftDelay_prev_flight_delay_info,
  CASE WHEN landed THEN coalesce(p_weather, 0) ELSE 0 END AS WeatherDelay_prev_flight_delay_info,
  CASE WHEN landed THEN coalesce(p_nas, 0) ELSE 0 END AS NASDelay_prev_flight_delay_info,
  CASE WHEN landed THEN coalesce(p_carrier, 0) ELSE 0 END AS CarrierDelay_prev_flight_delay_info
FROM known2"""))
def prev_leg_known_delay(spark, d):
    facts = chain.add_known_delay(chain.add_turnaround(chain.add_previous_leg(linked_columns(spark, d))))
    return facts.select(
        "FlightID", *rounded("Prev_flight_DelayMinutes", "Expected_Tournaround_time"),
        "Prev_flight_has_departed", "Airplane_already_at_airport",
        *[f"{r}_prev_flight_delay_info" for r in chain.REASONS],
    )


@query("turnaround", sql(["known"], """
SELECT FlightID, round(crs_turn, 6) AS CRSTurnaroundTime,
  round(CASE WHEN has IS NOT TRUE AND same_air THEN date_diff('second', p_crs_arr, CRSDepDateTime_UTC) / 60.0 ELSE 0 END, 6)
    AS Time_since_last_certified_record
FROM known"""))
def turnaround(spark, d):
    timed = chain.add_turnaround(chain.add_previous_leg(linked_columns(spark, d)))
    return timed.select("FlightID", *rounded("CRSTurnaroundTime", "Time_since_last_certified_record"))


@query("legs_per_day", sql(["legs"], """
SELECT FlightID, CASE WHEN Tail_Number IS NOT NULL THEN CAST(row_number() OVER w - 1 AS DOUBLE) END AS Flights_before_today,
  CASE WHEN Tail_Number IS NOT NULL THEN CAST(count(*) OVER (PARTITION BY Tail_Number, FlightDate) AS DOUBLE) END AS total_Flights_scheduled_today
FROM legs WINDOW w AS (PARTITION BY Tail_Number, FlightDate ORDER BY CRSDepDateTime_UTC, FlightID)"""))
def legs_per_day(spark, d):
    return chain.add_legs_per_day(legs(spark, d)).select(
        "FlightID", *rounded("Flights_before_today", "total_Flights_scheduled_today")
    )


@query("negative_turnaround", sql(["known"], """
SELECT FlightID, Tail_Number, round(crs_turn, 6) AS CRSTurnaroundTime FROM known
WHERE crs_turn < -15 AND Cancelled <> 1 AND Diverted <> 1"""))
def negative_turnaround(spark, d):
    rows = chain.negative_turnarounds(linked_columns(spark, d))
    return rows.select("FlightID", "Tail_Number", *rounded("CRSTurnaroundTime"))
