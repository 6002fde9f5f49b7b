"""Holidays, weather, date ranges."""

from pyspark.sql import functions as F

from legwork.operators import calendar, weather
from legwork.registry.base import TS, cte, day_text, legs, query, rounded, sql, text
from legwork.schemas import WEATHER_PARAMS
from legwork.sources import views

_NTH = "(make_date(y, {m}, 1) + CAST((({w} + 7 - isodow(make_date(y, {m}, 1))) % 7 + 7 * ({n} - 1)) AS INTEGER))"
_FIXED = {"New Year's Day": (1, 1, 0), "Juneteenth": (6, 19, 2021), "Independence Day": (7, 4, 0),
          "Veterans Day": (11, 11, 1938), "Christmas Day": (12, 25, 0)}
_FIXED_SQL = " UNION ALL ".join(
    f"SELECT y, make_date(y, {m}, {d}) AS day FROM years WHERE y >= {f}" for m, d, f in _FIXED.values()
)
_FLOAT_SQL = " UNION ALL ".join(
    f"SELECT y, {_NTH.format(m=m, w=w, n=n)} AS day FROM years WHERE y >= {f}"
    for m, w, n, f in ((1, 1, 3, 1986), (2, 1, 3, 1971), (9, 1, 1, 1894), (10, 1, 2, 1971), (11, 4, 4, 1942))
)
_HELD = {
    "fixed": _FIXED_SQL,
    "observed": """
SELECT y, CASE isodow(day) WHEN 6 THEN day - 1 WHEN 7 THEN day + 1 END AS day FROM
  (SELECT * FROM fixed UNION ALL SELECT y, make_date(y + 1, 1, 1) FROM years) WHERE isodow(day) >= 6""",
    "held": f"""
SELECT CAST(day AS DATE) AS day FROM (
  SELECT * FROM fixed UNION ALL SELECT * FROM observed UNION ALL {_FLOAT_SQL}
  UNION ALL SELECT y, last_day(make_date(y, 5, 1)) - CAST((isodow(last_day(make_date(y, 5, 1))) - 1) % 7 AS INTEGER) FROM years
  UNION ALL SELECT y, make_date(y, 12, 24) FROM years UNION ALL SELECT y, make_date(y, 12, 31) FROM years)
WHERE year(day) = y""",
}
HOLIDAY_SQL = sql(["train"], """
SELECT FlightID, CAST(d AS INTEGER) AS DaysToNearestHoliday, CASE WHEN d = 0 THEN 1 ELSE 0 END AS IsHoliday
FROM train JOIN (SELECT FlightDate, min(abs(date_diff('day', CAST(FlightDate AS DATE), h))) AS d
  FROM (SELECT DISTINCT FlightDate FROM train), (SELECT DISTINCT day AS h FROM held) GROUP BY FlightDate) USING (FlightDate)""",
    years="""
SELECT unnest(range(CAST(year(min(CAST(FlightDate AS DATE))) AS BIGINT), CAST(year(max(CAST(FlightDate AS DATE))) AS BIGINT) + 1))::INTEGER AS y
FROM train""", **_HELD)


@query("holiday_nearest", sql([], """
SELECT o_orderkey AS leg, strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(d AS INTEGER) AS DaysToNearestHoliday,
  CASE WHEN d = 0 THEN 1 ELSE 0 END AS IsHoliday
FROM orders JOIN (SELECT day AS o_day, min(abs(date_diff('day', day, h))) AS d
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), (SELECT DISTINCT day AS h FROM held) GROUP BY day)
ON CAST(o_orderdate AS DATE) = o_day""", years="""
SELECT unnest(range(CAST(year(min(o_orderdate)) AS BIGINT), CAST(year(max(o_orderdate)) AS BIGINT) + 1))::INTEGER AS y FROM orders""",
    **_HELD))
def holiday_nearest(spark, d):
    orders = views.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("leg"), day_text("o_orderdate").alias("day")
    )
    return calendar.add_holidays(orders, "day")


cte("readings", """
SELECT 'S' || (user_id % 7) AS station, date_trunc('hour', ts) AS "timestamp",
  avg(CAST(floor(value) AS INTEGER)) AS temp, avg(k) FILTER (WHERE k % 4 = 0) AS prcp,
  CAST(max(k) FILTER (WHERE k % 5 <> 0) AS DOUBLE) AS wspd, CAST(min(k) FILTER (WHERE event_id % 7 = 0) AS DOUBLE) AS rhum
FROM ev GROUP BY ALL""", ["ev"])
cte("choices", """
SELECT iata_code AS airport, 0 AS rank, airport_station AS station FROM airport_dim WHERE airport_station IS NOT NULL
UNION ALL SELECT iata_code, 1, closest_station_1 FROM airport_dim WHERE closest_station_1_distance < 50000
UNION ALL SELECT iata_code, 2, closest_station_2 FROM airport_dim WHERE closest_station_2_distance < 50000
UNION ALL SELECT iata_code, 3, closest_station_3 FROM airport_dim WHERE closest_station_3_distance < 50000""", ["airport_dim"])
cte("filled", """
SELECT airport, "timestamp", arg_min(temp, rank) FILTER (WHERE temp IS NOT NULL) AS temp,
  arg_min(prcp, rank) FILTER (WHERE prcp IS NOT NULL) AS prcp, arg_min(wspd, rank) FILTER (WHERE wspd IS NOT NULL) AS wspd,
  arg_min(rhum, rank) FILTER (WHERE rhum IS NOT NULL) AS rhum
FROM readings JOIN choices USING (station) GROUP BY ALL""", ["readings", "choices"])
cte("spans", """
SELECT airport, min(h) - to_hours(5) AS first_hour, max(h) + to_hours(5) AS last_hour FROM (
  SELECT Origin AS airport, floor_informationtime_UTC AS h FROM legs UNION ALL SELECT Dest, floor_informationtime_UTC FROM legs)
GROUP BY airport""", ["legs"])
cte("spine", """
SELECT airport, "timestamp", temp, prcp, wspd, rhum
FROM (SELECT airport, unnest(generate_series(first_hour, last_hour, INTERVAL 1 HOUR)) AS "timestamp" FROM spans)
LEFT JOIN filled USING (airport, "timestamp")""", ["spans", "filled"])
_CARRY = ", ".join(
    f"last_value({p} IGNORE NULLS) OVER w AS {p}" for p in WEATHER_PARAMS
)
cte("carried", f"""
SELECT airport, "timestamp", {_CARRY} FROM spine
WINDOW w AS (PARTITION BY airport ORDER BY "timestamp" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""", ["spine"])


def _weather(spark, d):
    return weather.airport_weather(legs(spark, d), views.airports(spark, d), views.station_weather(spark, d))


@query("weather_fallback", sql(["filled"], f"""
SELECT airport, strftime("timestamp", {TS}) AS hour, round(temp, 6) AS temp, round(prcp, 6) AS prcp, wspd, rhum FROM filled"""))
def weather_fallback(spark, d):
    series = weather.airport_readings(views.airports(spark, d), views.station_weather(spark, d))
    return series.select("airport", text("timestamp").alias("hour"), *rounded(*WEATHER_PARAMS))


@query("weather_fill", sql(["carried"], f"""
SELECT airport, strftime("timestamp", {TS}) AS hour, round(coalesce(temp, 0), 6) AS temp, round(coalesce(prcp, 0), 6) AS prcp,
  coalesce(wspd, 0) AS wspd, coalesce(rhum, 0) AS rhum FROM carried"""))
def weather_fill(spark, d):
    return _weather(spark, d).select("airport", text("timestamp").alias("hour"), *rounded(*WEATHER_PARAMS))


@query("weather_missing_share", sql(["carried"], """
SELECT airport, parameter, round(share, 6) AS missing_share, CASE WHEN share > 0.5 THEN 1 ELSE 0 END AS warn FROM (
  SELECT airport, unnest(['temp','prcp','wspd','rhum']) AS parameter,
    unnest([avg(CASE WHEN temp IS NULL THEN 1 ELSE 0 END), avg(CASE WHEN prcp IS NULL THEN 1 ELSE 0 END),
            avg(CASE WHEN wspd IS NULL THEN 1 ELSE 0 END), avg(CASE WHEN rhum IS NULL THEN 1 ELSE 0 END)]) AS share
  FROM carried GROUP BY airport)"""))
def weather_missing_share(spark, d):
    rows, dim = legs(spark, d), views.airports(spark, d)
    series = weather.airport_readings(dim, views.station_weather(spark, d))
    shares = weather.missing_share(weather.spine_with_readings(weather.airport_spans(rows), series))
    return shares.select("airport", "parameter", *rounded("missing_share"), "warn")


_ENDS = ", ".join(
    [f"round(coalesce(o.{p}, 0), 6) AS {p}_DEP, round(coalesce(a.{p}, 0), 6) AS {p}_ARR" for p in WEATHER_PARAMS]
)


@query("weather_join", sql(["legs", "carried"], f"""
SELECT FlightID, {_ENDS} FROM legs
JOIN carried o ON o.airport = Origin AND o."timestamp" = floor_informationtime_UTC
JOIN carried a ON a.airport = Dest AND a."timestamp" = floor_informationtime_UTC"""))
def weather_join(spark, d):
    joined = weather.attach_weather(legs(spark, d), _weather(spark, d))
    return joined.select("FlightID", *rounded(*[f"{p}_{e}" for p in WEATHER_PARAMS for e in ("DEP", "ARR")]))


@query("unmatched_rows", sql(["legs", "filled"], """
SELECT DISTINCT FlightID, Origin, Dest FROM legs
WHERE NOT EXISTS (SELECT 1 FROM filled f WHERE f.airport = Origin AND f."timestamp" = floor_informationtime_UTC)
  OR NOT EXISTS (SELECT 1 FROM filled f WHERE f.airport = Dest AND f."timestamp" = floor_informationtime_UTC)"""))
def unmatched_rows(spark, d):
    series = weather.airport_readings(views.airports(spark, d), views.station_weather(spark, d))
    return weather.unmatched_legs(legs(spark, d), series).select("FlightID", "Origin", "Dest")


@query("airport_date_range", sql(["spans"], f"""
SELECT airport, strftime(first_hour, {TS}) AS first_hour, strftime(last_hour, {TS}) AS last_hour FROM spans"""))
def airport_date_range(spark, d):
    spans = weather.airport_spans(legs(spark, d))
    return spans.select("airport", text("first_hour").alias("first_hour"), text("last_hour").alias("last_hour"))
