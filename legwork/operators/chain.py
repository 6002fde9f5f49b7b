"""The aircraft's previous leg and what is known of it at information time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwork.functions.scalars import flag, same
from legwork.functions.times import minutes_between
from legwork.operators.ranking import LAST_HOUR, positions, previous_row
from legwork.session import cut_to_table

PREVIOUS_FIELDS = [
    "FlightID", "Dest", "Origin", "FlightDate", "Reporting_Airline", "Cancelled", "Diverted",
    "CRSArrDateTime_UTC", "ArrDateTime_UTC", "CRSDepDateTime_UTC", "DepDateTime_UTC",
    "DepDelayMinutes", "ArrDelayMinutes",
    "LateAircraftDelay", "WeatherDelay", "NASDelay", "CarrierDelay",
]
REASONS = ["LateAircraftDelay", "WeatherDelay", "NASDelay", "CarrierDelay"]


def _hour() -> Column:
    return F.date_trunc("HOUR", "CRSDepDateTime_UTC")


def add_legs_per_day(legs: DataFrame) -> DataFrame:
    """How many legs the aircraft flew before this one on the day, and its total.

    Legs without a tail number or a day get neither; a leg without a planned time counts as the
    last of its day.
    """
    has_both = F.col("Tail_Number").isNotNull() & F.col("FlightDate").isNotNull()
    order = [F.asc_nulls_last("CRSDepDateTime_UTC"), "FlightID"]
    counted = positions(
        legs.filter(has_both), ["Tail_Number", "FlightDate"], [F.coalesce(_hour(), F.lit(LAST_HOUR))], order,
        "Flights_before_today", totals=True,
    ).withColumnRenamed("Flights_before_today_total", "total_Flights_scheduled_today")
    unknown = legs.filter(~has_both)
    return counted.unionByName(unknown, allowMissingColumns=True)


def add_previous_leg(legs: DataFrame) -> DataFrame:
    """Adds the struct ``prev`` (previous leg of the tail) and the flags on it."""
    order = ["CRSDepDateTime_UTC", "FlightID"]
    linked = previous_row(legs, "Tail_Number", F.trunc("CRSDepDateTime_UTC", "month"), order, PREVIOUS_FIELDS, "prev")
    p = F.col("prev")
    same_aircraft = p.isNotNull() & same(F.col("Reporting_Airline"), p["Reporting_Airline"])
    flown = same(p["Cancelled"], F.lit(0)) & same(p["Diverted"], F.lit(0))
    found = linked.withColumn("_found", same_aircraft)
    return found.withColumns(
        {
            "FirstFlightRecord": (~F.col("_found")).cast("int"),
            "has_prev_flight": flag(F.col("_found") & flown & same(F.col("Origin"), p["Dest"])),
            "Same_day_previous_flight": flag(p["FlightDate"] == F.col("FlightDate")),
            "is_Return_flight": flag((F.col("Origin") == p["Dest"]) & (F.col("Dest") == p["Origin"])),
        }
    )


def add_turnaround(linked: DataFrame) -> DataFrame:
    """Planned turnaround (mean where there is none) and time since a broken chain.

    The linked legs are written once below the shared folder, so the chain runs a single time; the
    mean is read from one column of the stored rows. (An observation during the write would save
    that read, but it leaves the session unserializable, and models with a training summary carry
    the session into their tasks.) Without any turnaround the mean, and so the column, is null.
    """
    gap = minutes_between(F.col("prev.CRSArrDateTime_UTC"), F.col("CRSDepDateTime_UTC"))
    has = F.col("has_prev_flight") == 1
    timed = linked.withColumn("_turn", F.when(has, gap))
    stored = cut_to_table(timed, "linked")
    mean = F.lit(stored.agg(F.avg("_turn").alias("mean")).first()["mean"]).cast("double")
    return stored.withColumns(
        {
            "CRSTurnaroundTime": F.coalesce(F.col("_turn"), mean),
            "Time_since_last_certified_record": F.coalesce(F.when(~has & F.col("_found"), gap), F.lit(0.0)),
        }
    ).drop("_turn")


def add_known_delay(linked: DataFrame) -> DataFrame:
    """What the information time reveals about the previous leg.

    The latest fact wins: a leg overdue at its destination, then an arrival, then a
    leg overdue at its origin, then a departure, else nothing.
    """
    now = F.col("Information_time_UTC")
    p = F.col("prev")
    has = F.col("has_prev_flight") == 1

    def passed(moment: Column) -> Column:
        return F.coalesce(has & (now >= moment), F.lit(False))

    due_out, out = passed(p["CRSDepDateTime_UTC"]), passed(p["DepDateTime_UTC"])
    due_in, landed = passed(p["CRSArrDateTime_UTC"]), passed(p["ArrDateTime_UTC"])
    known = (
        F.when(due_in & ~landed, minutes_between(p["CRSArrDateTime_UTC"], now))
        .when(landed, p["ArrDelayMinutes"])
        .when(due_out & ~out, minutes_between(p["CRSDepDateTime_UTC"], now))
        .when(out, p["DepDelayMinutes"])
        .otherwise(F.lit(0.0))
    )
    facts = linked.withColumns(
        {
            "Prev_flight_DelayMinutes": known,
            "Prev_flight_has_departed": out.cast("int"),
            "Airplane_already_at_airport": F.when(~has, 0.5).when(landed, 1.0).otherwise(0.0),
        }
    )
    expected = F.col("CRSTurnaroundTime") - F.col("Prev_flight_DelayMinutes")
    there = F.col("Airplane_already_at_airport") == 1.0
    return facts.withColumns(
        {
            "Expected_Tournaround_time": F.coalesce(expected, F.col("CRSTurnaroundTime")),
            **{
                f"{r}_prev_flight_delay_info": F.coalesce(F.when(there, p[r]), F.lit(0.0))
                for r in REASONS
            },
        }
    )


#: What is still read of the previous leg when the flags on it are known.
KNOWN_FIELDS = [
    "CRSArrDateTime_UTC", "ArrDateTime_UTC", "CRSDepDateTime_UTC", "DepDateTime_UTC",
    "DepDelayMinutes", "ArrDelayMinutes", *REASONS,
]


def add_chain(legs: DataFrame) -> DataFrame:
    """All previous-leg columns; the helper struct is removed."""
    linked = add_previous_leg(add_legs_per_day(legs))
    linked = linked.withColumn("prev", F.struct(*[F.col(f"prev.{c}") for c in KNOWN_FIELDS]))
    return add_known_delay(add_turnaround(linked)).drop("prev", "_found")


def negative_turnarounds(legs: DataFrame, limit: float = -15.0) -> DataFrame:
    """Completed legs whose planned turnaround is shorter than ``limit`` minutes."""
    linked = add_turnaround(add_previous_leg(legs))
    on = ~same(F.col("Cancelled"), F.lit(1)) & ~same(F.col("Diverted"), F.lit(1))
    return linked.filter(on & (F.col("CRSTurnaroundTime") < limit)).drop("prev", "_found")
