"""Streaming jobs over the events folder."""

from pyspark.sql import functions as F

from legwork.registry.base import TS, day_text, query, text
from legwork.sources import views
from legwork.streaming import jobs


def _events(spark, d):
    return jobs.read_stream(spark, d, "events.parquet", views.table(spark, d, "events"))


@query("stream_hourly_state", f"""
SELECT 'A' || (user_id % 7) AS airport, strftime(date_trunc('hour', ts), {TS}) AS hour, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS delay
FROM events GROUP BY ALL, date_trunc('hour', ts)
HAVING date_trunc('hour', max(ts)) + to_hours(1) <= (SELECT max(ts) FROM events) - to_minutes(10)""".replace("GROUP BY ALL, date_trunc('hour', ts)", "GROUP BY 1, date_trunc('hour', ts)"))
def stream_hourly_state(spark, d):
    moves = _events(spark, d).select(
        F.concat(F.lit("A"), F.col("user_id") % 7).alias("airport"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.floor("value").cast("bigint").alias("delay"),
    )
    found = jobs.run_append(jobs.hourly_state(moves), "hourly_state")
    return found.select("airport", text("hour").alias("hour"), "n", "delay")


@query("stream_daily_counts", """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS num_messages FROM events GROUP BY 1""")
def stream_daily_counts(spark, d):
    log = _events(spark, d).select(F.col("ts").cast("timestamp").alias("ts"))
    found = jobs.run_update(jobs.daily_counts(log), "daily_counts", "day")
    return found.select(day_text("day").alias("day"), "num_messages")
