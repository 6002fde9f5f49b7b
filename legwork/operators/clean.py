"""Raw on-time records -> cleaned legs with local and UTC times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwork.functions import times as t
from legwork.functions.scalars import same
from legwork.operators.ranking import positions
from legwork.schemas import HOURS_BEFORE, SCOPE_AIRLINES, SCOPE_AIRPORTS


def in_scope(legs: DataFrame, airlines=SCOPE_AIRLINES, airports=SCOPE_AIRPORTS) -> DataFrame:
    """Legs of the listed airlines that touch a listed airport."""
    touches = F.col("Origin").isin(airports) | F.col("Dest").isin(airports)
    return legs.filter(F.col("Reporting_Airline").isin(airlines) & touches)


def add_flight_id(raw: DataFrame) -> DataFrame:
    """Adds FlightID, the place of each record in order of day, planned time and all other columns.

    Only equal records can swap their ids between runs. Days and hours are counted first, so
    no task orders more than the records of one hour of one day.
    """
    first = ["FlightDate", "CRSDepTime", "Reporting_Airline", "Flight_Number_Reporting_Airline"]
    order = first + [c for c in raw.columns if c not in first]
    cells = [F.coalesce("FlightDate", F.lit("")), F.floor(F.col("CRSDepTime") / 100)]
    return positions(raw, [], cells, order, "FlightID").withColumn("FlightID", F.col("FlightID").cast("bigint"))


def between_listed(legs: DataFrame, airports=SCOPE_AIRPORTS) -> DataFrame:
    """Legs whose two ends are listed."""
    return legs.filter(F.col("Origin").isin(airports) & F.col("Dest").isin(airports))


def completed(legs: DataFrame) -> DataFrame:
    """Neither cancelled nor diverted."""
    off = same(F.col("Cancelled"), F.lit(1)) | same(F.col("Diverted"), F.lit(1))
    return legs.filter(~off)


def training_rows(legs: DataFrame, airports=SCOPE_AIRPORTS, min_year: int | None = None) -> DataFrame:
    """Completed legs between listed airports with a planned duration."""
    rows = completed(between_listed(legs.filter(F.col("CRSElapsedTime").isNotNull()), airports))
    return rows if min_year is None else rows.filter(F.col("Year") >= min_year)


def drop_lost_legs(legs: DataFrame) -> DataFrame:
    """Removes legs without an arrival time that were neither cancelled nor diverted."""
    lost = (
        F.col("ArrTime").isNull()
        & same(F.col("Cancelled"), F.lit(0))
        & same(F.col("Diverted"), F.lit(0))
    )
    return legs.filter(~lost)


def parse_clock_times(legs: DataFrame) -> DataFrame:
    """The four HHMM columns become minutes of the day.

    A cancelled leg keeps only times that were recorded; a diverted leg has no
    arrival time.
    """
    parsed = {c: t.minutes_of_hhmm(F.col(c)) for c in ("CRSDepTime", "DepTime", "CRSArrTime", "ArrTime")}
    parsed["ArrTime"] = F.when(~same(F.col("Diverted"), F.lit(1)), parsed["ArrTime"])
    return legs.withColumns(parsed)


def missing_zones(legs: DataFrame, airports: DataFrame) -> DataFrame:
    """Airport codes used by legs that the airport dimension does not know."""
    used = (
        legs.select(F.lit("Origin").alias("role"), F.col("Origin").alias("iata_code"))
        .union(legs.select(F.lit("Dest"), F.col("Dest")))
        .groupBy("role", "iata_code")
        .agg(F.count(F.lit(1)).alias("legs"))
    )
    known = airports.filter(F.col("TZ").isNotNull()).select("iata_code")
    return used.join(known, "iata_code", "left_anti").select("role", "iata_code", "legs")


def attach_zones(legs: DataFrame, airports: DataFrame, strict: bool = True) -> DataFrame:
    """Joins the zone of both ends; in strict mode an unknown airport fails the job."""
    found = {}
    for end in ("Origin", "Dest"):
        zone = airports.select(F.col("iata_code").alias(end), F.col("TZ").alias(f"TZ_{end}"))
        legs = legs.join(zone, end, "left")
        text = F.concat(F.lit(f"Missing timezone data for {end} "), F.col(end))
        found[f"TZ_{end}"] = F.coalesce(F.col(f"TZ_{end}"), F.raise_error(text).cast("string"))
    return legs.withColumns(found) if strict else legs


def add_timestamps(legs: DataFrame) -> DataFrame:
    """Local and UTC timestamps of the planned and actual movements."""
    c = F.col
    midnight = c("FlightDate").cast("date").cast("timestamp_ntz")
    # a late departure whose clock time is before the plan left the next day
    next_day = F.coalesce(((c("DepTime") < c("CRSDepTime")) & (c("DepDelay") > 0)).cast("int"), F.lit(0))
    local = {
        "CRSDepDateTime": t.plus_minutes(midnight, c("CRSDepTime")),
        "DepDateTime": t.plus_minutes(midnight, c("DepTime") + next_day * 1440),
        "CRSArrDateTime": t.plus_minutes(midnight, c("CRSArrTime")),
        "ArrDateTime": t.plus_minutes(midnight, c("ArrTime")),
    }
    zone = {name: "TZ_Origin" if "Dep" in name else "TZ_Dest" for name in local}
    legs = legs.withColumns(local)
    legs = legs.withColumns({f"{n}_UTC": t.to_utc(n, zone[n]) for n in local})
    legs = legs.withColumns({f"{n}_UTC": t.leave_gap(f"{n}_UTC", n, zone[n]) for n in local})
    # an arrival before its departure belongs to the next day
    rolled = {"UTC_CRS_FlightDate": F.to_date("CRSDepDateTime_UTC")}
    for plan in ("CRS", ""):
        early = c(f"{plan}ArrDateTime_UTC") < c(f"{plan}DepDateTime_UTC")
        for name in (f"{plan}ArrDateTime", f"{plan}ArrDateTime_UTC"):
            rolled[name] = F.when(early, c(name) + t.interval(days=1)).otherwise(c(name))
    return legs.withColumns(rolled)


def add_information_time(legs: DataFrame, hours_before: int = HOURS_BEFORE) -> DataFrame:
    """The moment up to which facts may be used, and the full hour before it."""
    back = t.interval(hours=hours_before)
    utc, local = F.col("CRSDepDateTime_UTC") - back, F.col("CRSDepDateTime") - back
    return legs.withColumns(
        {
            "Information_time_UTC": utc,
            "Information_time": local,
            "floor_informationtime_UTC": t.floor_hour(utc),
            "floor_informationtime": t.floor_hour(local),
        }
    )


def clean_legs(raw: DataFrame, airports: DataFrame, hours_before: int = HOURS_BEFORE) -> DataFrame:
    """All cleaning steps, one lazy plan without a shuffle of the legs."""
    legs = parse_clock_times(drop_lost_legs(raw))
    legs = add_timestamps(attach_zones(legs, airports))
    return add_information_time(legs, hours_before)
