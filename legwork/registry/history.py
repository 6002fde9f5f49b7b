"""Daily history, lags and flight-number history."""

from pyspark.sql import functions as F

from legwork.functions.scalars import class_ordinal, delay_class
from legwork.operators import clean, history
from legwork.registry.base import cte, legs, query, rounded, sql
from legwork.sources import views


def train(spark, d):
    return clean.training_rows(legs(spark, d), views.VIEW_SCOPE_AIRPORTS, min_year=2014)


def _daily(name, group):
    cte(name, f"""
SELECT FlightDate, {group} AS grp, avg(ArrDelayMinutes) AS daily FROM train
WHERE {group} IS NOT NULL GROUP BY ALL""", ["train"])


for _name, _group in (("by_origin", "Origin"), ("by_dest", "Dest"), ("by_airline", "Reporting_Airline")):
    _daily(_name, _group)


def _hist_sql(table, prefix):
    frame = "OVER (PARTITION BY grp ORDER BY FlightDate ROWS BETWEEN {} AND 1 PRECEDING)"
    return f"""
SELECT FlightDate, grp, daily,
  avg(daily) {frame.format('UNBOUNDED PRECEDING')} AS hist_{prefix}_delay,
  avg(daily) {frame.format('7 PRECEDING')} AS hist_{prefix}_delay_7d,
  avg(daily) {frame.format('30 PRECEDING')} AS hist_{prefix}_delay_30d,
  lag(daily, 1) OVER (PARTITION BY grp ORDER BY FlightDate) AS {prefix}_yesterday_delay,
  lag(daily, 7) OVER (PARTITION BY grp ORDER BY FlightDate) AS {prefix}_lastweek_delay
FROM {table}"""


@query("hist_delay_origin", sql(["train", "by_origin"], """
SELECT Origin, CAST(count(*) AS BIGINT) AS legs, round(avg(h), 6) AS hist_origin_delay, round(avg(h7), 6) AS hist_origin_delay_7d,
  round(avg(h30), 6) AS hist_origin_delay_30d, CAST(count(*) FILTER (WHERE ArrDelayMinutes <= 15) AS BIGINT) AS on_time,
  CAST(max(CASE WHEN h <= 15 THEN 0 WHEN h <= 60 THEN 1 WHEN h <= 180 THEN 2 ELSE 3 END) AS INTEGER) AS worst_history_class
FROM (SELECT t.Origin, t.ArrDelayMinutes, coalesce(hist_origin_delay, 0) AS h, coalesce(hist_origin_delay_7d, 0) AS h7,
        coalesce(hist_origin_delay_30d, 0) AS h30
      FROM train t LEFT JOIN hist ON hist.FlightDate = t.FlightDate AND hist.grp = t.Origin)
GROUP BY Origin""", hist=_hist_sql("by_origin", "origin")))
def hist_delay_origin(spark, d):
    rows = history.add_group_history(train(spark, d), "Origin", "origin", lags=False)
    names = ["hist_origin_delay", "hist_origin_delay_7d", "hist_origin_delay_30d"]
    return rows.groupBy("Origin").agg(
        F.count(F.lit(1)).alias("legs"),
        *[F.round(F.avg(n), 6).alias(n) for n in names],
        F.count_if(delay_class(F.col("ArrDelayMinutes")) == "no_delay").alias("on_time"),
        F.max(class_ordinal(delay_class(F.col("hist_origin_delay")))).alias("worst_history_class"),
    )


def group_sql(table, prefix, group, columns):
    picks = ", ".join(f"round(coalesce({c}, 0), 6) AS {c}" for c in columns)
    return sql(["train", table], f"""
SELECT FlightID, {picks} FROM train t LEFT JOIN hist ON hist.FlightDate = t.FlightDate AND hist.grp = t.{group}""",
               hist=_hist_sql(table, prefix))


def hist_names(prefix):
    return [f"hist_{prefix}_delay{s}" for s in ("", "_7d", "_30d")]


@query("hist_delay_carrier", group_sql("by_airline", "airline", "Reporting_Airline", hist_names("airline")))
def hist_delay_carrier(spark, d):
    rows = history.add_group_history(train(spark, d), "Reporting_Airline", "airline", lags=False)
    return rows.select("FlightID", *rounded(*hist_names("airline")))


@query("hist_delay_dest", group_sql("by_dest", "dest", "Dest", hist_names("dest")))
def hist_delay_dest(spark, d):
    rows = history.add_group_history(train(spark, d), "Dest", "dest", lags=False)
    return rows.select("FlightID", *rounded(*hist_names("dest")))


_LAGS = ["origin_yesterday_delay", "origin_lastweek_delay"]


@query("lag_delay_group", group_sql("by_origin", "origin", "Origin", _LAGS))
def lag_delay_group(spark, d):
    rows = train(spark, d)
    daily = history.add_day_lags(history.daily_mean(rows, "Origin"), "Origin", "origin")
    return history.attach_daily(rows, daily, "Origin", _LAGS).select("FlightID", *rounded(*_LAGS))


@query("lag_delay_global", sql(["train"], """
SELECT FlightID, round(coalesce(y, 0), 6) AS global_yesterday_delay, round(coalesce(w, 0), 6) AS global_lastweek_delay
FROM train JOIN lags USING (FlightDate)""", daily="""
SELECT FlightDate, avg(ArrDelayMinutes) AS m FROM train GROUP BY FlightDate""", lags="""
SELECT FlightDate, lag(m, 1) OVER (ORDER BY FlightDate) AS y, lag(m, 7) OVER (ORDER BY FlightDate) AS w FROM daily"""))
def lag_delay_global(spark, d):
    rows = history.add_group_history(train(spark, d), None, "global")
    return rows.select("FlightID", *rounded("global_yesterday_delay", "global_lastweek_delay"))


@query("hist_flight_median", sql(["train"], """
SELECT FlightID, round(coalesce(avg(ArrDelayMinutes) OVER a, 0), 6) AS hist_flg_delay,
  round(coalesce(quantile_cont(ArrDelayMinutes, 0.5) OVER a, 0), 6) AS hist_flg_median_delay,
  round(count(ArrDelayMinutes) OVER a, 6)::DOUBLE AS hist_flg_count_delay,
  round(coalesce(avg(ArrDelayMinutes) OVER b, 0), 6) AS hist_flg_delay_30d,
  round(coalesce(quantile_cont(ArrDelayMinutes, 0.5) OVER b, 0), 6) AS hist_flg_median_delay_30d,
  round(count(ArrDelayMinutes) OVER b, 6)::DOUBLE AS hist_flg_count_delay_30d
FROM (SELECT *, Reporting_Airline || CAST(Flight_Number_Reporting_Airline AS VARCHAR) AS flg FROM train)
WINDOW a AS (PARTITION BY flg ORDER BY FlightDate, CRSDepDateTime_UTC, FlightID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  b AS (PARTITION BY flg ORDER BY FlightDate, CRSDepDateTime_UTC, FlightID ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"""))
def hist_flight_median(spark, d):
    rows = history.add_flight_history(train(spark, d))
    return rows.select("FlightID", *rounded(*history.FLIGHT_HISTORY))


@query("prev_month_mean", """
WITH legs0 AS (SELECT o_orderkey, o_orderpriority AS Origin, o_orderdate, year(o_orderdate) AS y, month(o_orderdate) AS m,
    CAST(floor(o_totalprice) AS BIGINT) % 400 - 30 AS late FROM orders),
monthly AS (SELECT Origin, y, m, avg(late) AS mean FROM legs0 GROUP BY ALL),
shifted AS (SELECT Origin, CASE WHEN m = 12 THEN y + 1 ELSE y END AS y, CASE WHEN m = 12 THEN 1 ELSE m + 1 END AS m, mean FROM monthly)
SELECT o_orderkey AS leg, round(mean, 6) AS prev_AvgArrDelay FROM legs0 LEFT JOIN shifted USING (Origin, y, m)""")
def prev_month_mean(spark, d):
    orders = views.table(spark, d, "orders")
    rows = orders.select(
        F.col("o_orderkey").alias("leg"),
        F.col("o_orderpriority").alias("Origin"),
        F.col("o_orderdate").alias("CRSDepDateTime"),
        F.year("o_orderdate").alias("Year"),
        F.month("o_orderdate").alias("Month"),
        (F.floor("o_totalprice") % 400 - 30).cast("double").alias("ArrDelay"),
    )
    return history.previous_month_mean(rows).select("leg", *rounded("prev_AvgArrDelay"))
