"""Day-so-far airport state and hourly spines."""

from pyspark.sql import functions as F

from legwork.functions.times import floor_hour
from legwork.operators import state
from legwork.registry.base import TS, cte, day_text, legs, query, rounded, sql, text
from legwork.registry.history import train  # noqa: F401
from legwork.schemas import HOURS_BEFORE

_CEIL = "CASE WHEN date_trunc('hour', {t}) = {t} THEN {t} ELSE date_trunc('hour', {t}) + to_hours(1) END"


def _counts(airport, day, moment, values):
    sums = "".join(f", sum(coalesce({v}, 0)) AS {v}" for v in values)
    return f"""
SELECT {airport} AS airport, {day} AS day, {_CEIL.format(t=moment)} AS hour, count(*) AS n{sums}
FROM legs WHERE Cancelled = 0 AND {moment} IS NOT NULL GROUP BY ALL"""


_MOVED = "(DepDateTime + to_minutes(CAST(ActualElapsedTime AS INTEGER)))"
cte("dep_counts", _counts("Origin", "FlightDate", "DepDateTime", ["DepDelayMinutes"]), ["legs"])
cte("arr_counts", _counts("Dest", "strftime(CRSArrDateTime, '%Y-%m-%d')", "ArrDateTime",
                          ["ArrDelayMinutes", "WeatherDelay", "NASDelay"]), ["legs"])
cte("gone_counts", _counts("Origin", f"strftime({_MOVED}, '%Y-%m-%d')", _MOVED, ["ArrDelayMinutes", "NASDelay"]), ["legs"])


def _lookup_sql(counts, prefix, values):
    cols = [f"coalesce(sum(s.n), 0)::BIGINT AS {prefix}_cum_count_sfd",
            f"coalesce(max(s.n) FILTER (WHERE s.hour = f), max(s.n) FILTER (WHERE s.hour = f - to_hours(1)), 0)::BIGINT AS {prefix}_count_fligts_lh"]
    for v in values:
        here = "max(s.{v} / s.n) FILTER (WHERE s.hour = f{back})"
        cols += [
            f"round(coalesce(sum(s.{v}), 0), 6) AS {prefix}_cum_{v}_sfd",
            f"round(coalesce(sum(s.{v}) / sum(s.n), 0), 6) AS {prefix}_avg_{v}_sfd",
            f"round(coalesce({here.format(v=v, back='')}, {here.format(v=v, back=' - to_hours(1)')}, 0), 6) AS {prefix}_avg_{v}_lh",
        ]
    return sql(["legs", counts], f"""
SELECT FlightID, {', '.join(cols)}
FROM (SELECT FlightID, Origin, FlightDate, floor_informationtime AS f FROM legs) l
LEFT JOIN {counts} s ON s.airport = l.Origin AND s.day = l.FlightDate AND s.hour <= f
GROUP BY FlightID""")


def _per_leg(spark, d, build):
    rows = legs(spark, d)
    table = build(rows, 2014)
    columns = [c for c in table.columns if c not in state.STATE_KEYS]
    counts = [c for c in columns if "count" in c]
    others = [c for c in columns if c not in counts]
    joined = state.attach_state(rows, table)
    return joined.select("FlightID", *[F.col(c).cast("bigint").alias(c) for c in counts], *rounded(*others))


@query("day_so_far_dep", _lookup_sql("dep_counts", "R_dep", ["DepDelayMinutes"]))
def day_so_far_dep(spark, d):
    return _per_leg(spark, d, state.departures_state)


@query("day_so_far_arr", _lookup_sql("arr_counts", "R_arr_origin", ["ArrDelayMinutes", "WeatherDelay", "NASDelay"]))
def day_so_far_arr(spark, d):
    return _per_leg(spark, d, state.arrivals_state)


@query("day_so_far_landed", _lookup_sql("gone_counts", "R_dest_arrived", ["ArrDelayMinutes", "NASDelay"]))
def day_so_far_landed(spark, d):
    return _per_leg(spark, d, state.landed_elsewhere_state)


@query("cancel_so_far", sql(["legs"], f"""
SELECT airport, day, strftime(hour, {TS}) AS hour, CAST(sum(cancelled) OVER w AS BIGINT) AS cum_cancelled,
  CAST(sum(departed) OVER w AS BIGINT) AS cum_count,
  round(CASE WHEN sum(departed) OVER w = 0 THEN 0 ELSE sum(late) OVER w / sum(departed) OVER w END, 6) AS avg_delay,
  CAST(departed AS BIGINT) AS flights_in_last_hour
FROM counts WINDOW w AS (PARTITION BY airport, day ORDER BY hour)""", counts=f"""
SELECT Origin AS airport, FlightDate AS day, coalesce({_CEIL.format(t='DepDateTime')}, CAST(FlightDate AS TIMESTAMP)) AS hour,
  sum(Cancelled) AS cancelled, sum(1 - Cancelled) AS departed, sum(coalesce(DepDelayMinutes, 0)) AS late
FROM legs GROUP BY ALL"""))
def cancel_so_far(spark, d):
    rows = state.cancelled_so_far(legs(spark, d))
    return rows.select(
        "airport", day_text("day").alias("day"), text("hour").alias("hour"),
        "cum_cancelled", "cum_count", *rounded("avg_delay"), "flights_in_last_hour",
    )


@query("range_join_same_day", sql(["legs"], """
SELECT a.FlightID, round(coalesce(avg(b.DepDelay), 0), 6) AS AvgDelaySameDaySameAirport
FROM legs a LEFT JOIN legs b ON b.Origin = a.Origin AND b.FlightDate = a.FlightDate
  AND b.CRSDepDateTime <= a.CRSDepDateTime - to_hours(2)
GROUP BY a.FlightID"""))
def range_join_same_day(spark, d):
    rows = state.mean_before_cutoff(legs(spark, d), HOURS_BEFORE)
    return rows.select("FlightID", *rounded("AvgDelaySameDaySameAirport"))


@query("hour_spine_fill", sql(["legs"], f"""
SELECT Origin, strftime(hour, {TS}) AS hour, coalesce(n, last_value(n IGNORE NULLS) OVER w, 0)::BIGINT AS departures,
  CASE WHEN n IS NULL THEN 1 ELSE 0 END AS gap
FROM spine LEFT JOIN counts USING (Origin, hour)
WINDOW w AS (PARTITION BY Origin ORDER BY hour ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""", counts="""
SELECT Origin, date_trunc('hour', CRSDepDateTime) AS hour, count(*) AS n FROM legs GROUP BY ALL""", spine="""
SELECT Origin, unnest(generate_series((SELECT min(hour) FROM counts), (SELECT max(hour) FROM counts), INTERVAL 1 HOUR)) AS hour
FROM (SELECT DISTINCT Origin FROM counts)"""))
def hour_spine_fill(spark, d):
    rows = legs(spark, d)
    counts = rows.groupBy("Origin", floor_hour(F.col("CRSDepDateTime")).alias("hour")).agg(
        F.count(F.lit(1)).alias("departures")
    )
    spine = state.hour_spine(rows, "Origin", "CRSDepDateTime").join(counts, ["Origin", "hour"], "left")
    spine = spine.withColumn("gap", F.col("departures").isNull().cast("int"))
    filled = state.forward_fill(spine, ["Origin"], "hour", ["departures"], 2).fillna(0, ["departures"])
    return filled.select("Origin", text("hour").alias("hour"), "departures", "gap")
