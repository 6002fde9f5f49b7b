"""Message log as time series and as directed graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwork.functions.times import interval, week_label


def overview(log: DataFrame) -> DataFrame:
    """Messages, first and last moment, distinct people in either role."""
    people = log.select("src").union(log.select("dst")).distinct().agg(F.count("src")).scalar()
    return log.agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("datetime").alias("first_at"),
        F.max("datetime").alias("last_at"),
    ).withColumn("people", people)


def _counts(log: DataFrame, label: Column, step_days: int) -> DataFrame:
    counts = log.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("num_messages"))
    span = counts.agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    spine = span.select(F.explode(F.sequence("lo", "hi", interval(days=step_days))).alias("label"))
    return spine.join(counts, "label", "left").select(
        "label", F.coalesce("num_messages", F.lit(0)).alias("num_messages")
    )


def daily_counts(log: DataFrame) -> DataFrame:
    """Messages per day; a day without any counts 0."""
    return _counts(log, F.to_date("datetime"), 1)


def weekly_counts(log: DataFrame) -> DataFrame:
    """Messages per week, labelled with the Sunday that closes it."""
    return _counts(log, week_label(F.to_date("datetime")), 7)


def hour_counts(log: DataFrame) -> DataFrame:
    """Messages by hour of day."""
    return log.groupBy(F.hour("datetime").alias("hour")).agg(F.count(F.lit(1)).alias("num_messages"))


def edge_weights(log: DataFrame) -> DataFrame:
    """Messages per ordered pair."""
    return log.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))


def weekly_edges(log: DataFrame) -> DataFrame:
    """Messages per ordered pair and week."""
    return log.groupBy(week_label(F.to_date("datetime")).alias("week"), "src", "dst").agg(
        F.count(F.lit(1)).alias("weight")
    )


def degree_leaders(weights: DataFrame, top: int = 10) -> DataFrame:
    """The people with most distinct partners, as senders and as receivers."""
    out = weights.groupBy(F.col("src").alias("person")).agg(F.count(F.lit(1)).alias("degree"))
    into = weights.groupBy(F.col("dst").alias("person")).agg(F.count(F.lit(1)).alias("degree"))

    def best(table: DataFrame, role: str) -> DataFrame:
        return table.orderBy(F.desc("degree"), "person").limit(top).withColumn("role", F.lit(role))

    return best(out, "out").unionByName(best(into, "in"))
