"""Delay history and lags: what earlier days and earlier legs looked like."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwork.operators.ranking import LAST_HOUR, positions
from legwork.schemas import DELAY_COLUMN


def daily_mean(
    legs: DataFrame, group: str | None, value: str = DELAY_COLUMN, name: str = "daily_mean"
) -> DataFrame:
    """Mean of ``value`` per day, or per day and group (null groups left out)."""
    keys = ["FlightDate"] + ([group] if group else [])
    rows = legs.filter(F.col(group).isNotNull()) if group else legs
    return rows.groupBy(*keys).agg(F.avg(value).alias(name))


def _days(group: str | None):
    return Window.partitionBy(*([group] if group else [])).orderBy("FlightDate")


def add_history(daily: DataFrame, group: str | None, prefix: str, value: str = "daily_mean") -> DataFrame:
    """Expanding, 7-row and 30-row mean of the days before each day."""
    days = _days(group)
    name = f"hist_{prefix}_delay"
    return daily.withColumns(
        {
            name: F.avg(value).over(days.rowsBetween(Window.unboundedPreceding, -1)),
            f"{name}_7d": F.avg(value).over(days.rowsBetween(-7, -1)),
            f"{name}_30d": F.avg(value).over(days.rowsBetween(-30, -1)),
        }
    )


def add_day_lags(daily: DataFrame, group: str | None, prefix: str, value: str = "daily_mean") -> DataFrame:
    """Mean of the previous recorded day and of the seventh before."""
    days = _days(group)
    return daily.withColumns(
        {
            f"{prefix}_yesterday_delay": F.lag(value, 1).over(days),
            f"{prefix}_lastweek_delay": F.lag(value, 7).over(days),
        }
    )


def attach_daily(legs: DataFrame, daily: DataFrame, group: str | None, columns: list[str]) -> DataFrame:
    """Joins daily columns back to the legs; a day without history counts 0."""
    keys = ["FlightDate"] + ([group] if group else [])
    joined = legs.join(daily.select(*keys, *columns), keys, "left")
    return joined.fillna(0.0, subset=columns)


def group_history(
    legs: DataFrame, group: str | None, prefix: str, lags: bool = True
) -> tuple[DataFrame, list[str]]:
    """Daily history and lag columns of one grouping, and their names."""
    daily = daily_mean(legs, group)
    columns = []
    if group is not None:
        daily = add_history(daily, group, prefix)
        columns += [f"hist_{prefix}_delay{s}" for s in ("", "_7d", "_30d")]
    if lags:
        daily = add_day_lags(daily, group, prefix)
        columns += [f"{prefix}_yesterday_delay", f"{prefix}_lastweek_delay"]
    return daily, columns


def add_group_history(legs: DataFrame, group: str | None, prefix: str, lags: bool = True) -> DataFrame:
    """History and lags of one grouping from one daily table and one join."""
    daily, columns = group_history(legs, group, prefix, lags)
    return attach_daily(legs, daily, group, columns)


# --- per flight number ----------------------------------------------------------------
FLIGHT_HISTORY = [
    "hist_flg_delay", "hist_flg_median_delay", "hist_flg_count_delay",
    "hist_flg_delay_30d", "hist_flg_median_delay_30d", "hist_flg_count_delay_30d",
]
FLIGHT_ORDER = ["FlightDate", "CRSDepDateTime_UTC", "FlightID"]


def flight_number() -> Column:
    return F.concat("Reporting_Airline", F.col("Flight_Number_Reporting_Airline").cast("string"))


def add_flight_history(legs: DataFrame, value: str = DELAY_COLUMN, run_legs: int = 4096) -> DataFrame:
    """Mean, median and count of the earlier legs and of the last 30 legs per flight number.

    Every flight number is cut into runs of ``run_legs`` legs (30 at least), so no task holds
    a whole large key. A run starts with a summary of everything earlier, as values with
    counts, and the 30 legs before it. A leg without a flight number has no history. Legs
    without a day come after all others, and those without a planned time last in their day.
    """
    keyed = legs.withColumn("_flg", flight_number())
    # "~" stands behind every date, which begins with a digit
    day = F.coalesce(F.col("FlightDate").cast("string"), F.lit("~"))
    hour = F.coalesce(F.date_trunc("HOUR", "CRSDepDateTime_UTC"), F.lit(LAST_HOUR))
    known = keyed.filter(F.col("_flg").isNotNull())
    placed = positions(known, ["_flg"], [day, hour], [F.asc_nulls_last(c) for c in FLIGHT_ORDER], "_pos")
    placed = placed.withColumns({"_run": F.floor(F.col("_pos") / run_legs), "_v": F.col(value).cast("double")})

    # kinds in their order within a run: 0 summary, 1 leg of the run before, 2 leg of the run
    last = F.col("_pos") % run_legs >= run_legs - 30
    kinds = F.when(last, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    shown = placed.select("*", F.explode(kinds).alias("_kind")).withColumns(
        {
            "_run": F.when(F.col("_kind") == 1, F.col("_run") + 1).otherwise(F.col("_run")),
            "_n": F.when(F.col("_kind") == 1, 0).otherwise(1).cast("bigint"),
        }
    )
    rows = shown.unionByName(_earlier_values(placed), allowMissingColumns=True)

    run = Window.partitionBy("_flg", "_run").orderBy("_kind", "_pos")
    earlier = run.rowsBetween(Window.unboundedPreceding, -1)
    recent = run.rowsBetween(-30, -1)
    count = F.sum(F.when(F.col("_v").isNotNull(), F.col("_n"))).over(earlier)
    half = F.lit(0.5)
    result = rows.withColumns(
        {
            "hist_flg_delay": F.when(count > 0, F.sum(F.col("_v") * F.col("_n")).over(earlier) / count),
            "hist_flg_median_delay": F.percentile("_v", half, F.col("_n")).over(earlier),
            "hist_flg_count_delay": count.cast("double"),
            "hist_flg_delay_30d": F.avg("_v").over(recent),
            "hist_flg_median_delay_30d": F.percentile("_v", half).over(recent),
            "hist_flg_count_delay_30d": F.count("_v").over(recent).cast("double"),
        }
    ).filter("_kind = 2").drop("_pos", "_run", "_v", "_kind", "_n")
    unknown = keyed.filter(F.col("_flg").isNull())
    result = result.unionByName(unknown, allowMissingColumns=True)
    return result.drop("_flg").fillna(0.0, subset=FLIGHT_HISTORY)


def _earlier_values(placed: DataFrame) -> DataFrame:
    """Values with their counts in all runs before, for every run but the first.

    Minutes take few distinct values, so these rows stay fewer than the legs they stand for.
    """
    seen = placed.filter("_v IS NOT NULL").groupBy("_flg", "_run", "_v").agg(F.count(F.lit(1)).alias("_c"))
    last_run = placed.groupBy("_flg").agg(F.max("_run").alias("_last")).filter("_last > 0")
    by_value = Window.partitionBy("_flg", "_v").orderBy("_run")
    # a cumulative count holds from the run after this one up to the next change
    steps = seen.join(last_run, "_flg").select(
        "_flg",
        "_v",
        F.sum("_c").over(by_value.rowsBetween(Window.unboundedPreceding, 0)).alias("_n"),
        (F.col("_run") + 1).alias("_from"),
        F.coalesce(F.lead("_run").over(by_value), F.col("_last")).alias("_to"),
    ).filter("_from <= _to")
    return steps.select(
        "_flg", "_v", "_n", F.explode(F.sequence("_from", "_to")).alias("_run"), F.lit(0).alias("_kind")
    )


def previous_month_mean(legs: DataFrame, value: str = "ArrDelay", name: str = "prev_AvgArrDelay") -> DataFrame:
    """Adds the mean of the calendar month before, per origin."""
    monthly = legs.groupBy("Origin", "Year", "Month").agg(F.avg(value).alias(name))
    following = F.add_months(F.make_date("Year", "Month", F.lit(1)), 1)
    shifted = monthly.select(
        "Origin",
        F.year(following).alias("_y"),
        F.month(following).alias("_m"),
        name,
    )
    keyed = legs.withColumns({"_y": F.year("CRSDepDateTime"), "_m": F.month("CRSDepDateTime")})
    return keyed.join(shifted, ["Origin", "_y", "_m"], "left").drop("_y", "_m")
