"""Holidays and the distance of a day to the nearest one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: days off at a fixed date (month, day, first year) ---------------------
FIXED_HOLIDAYS = {
    "New Year's Day": (1, 1, 1871),
    "Juneteenth": (6, 19, 2021),
    "Independence Day": (7, 4, 1871),
    "Veterans Day": (11, 11, 1938),
    "Christmas Day": (12, 25, 1871),
}
# --- Fixed values: days off on the n-th Monday/Thursday (month, weekday, n, first year) --
# weekday names as next_day() takes them; n = -1 is the last one of the month
FLOATING_HOLIDAYS = {
    "Martin Luther King Jr. Day": (1, "MON", 3, 1986),
    "Washington's Birthday": (2, "MON", 3, 1971),
    "Memorial Day": (5, "MON", -1, 1971),
    "Labor Day": (9, "MON", 1, 1894),
    "Columbus Day": (10, "MON", 2, 1971),
    "Thanksgiving": (11, "THU", 4, 1942),
}
# --- Fixed values: eves that count as holidays too --------------------------------------
EVES = {"Christmas Eve": (12, 24), "New Year's Eve": (12, 31)}


def _entry(day: Column, name: str, first_year: int) -> Column:
    valid = F.when(F.year(day) >= first_year, day)
    return F.struct(valid.alias("day"), F.lit(name).alias("holiday"))


def _nth_weekday(year: Column, month: int, weekday: str, n: int) -> Column:
    if n < 0:
        return F.date_sub(F.next_day(F.last_day(F.make_date(year, F.lit(month), F.lit(1))), weekday), 7)
    before = F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1)
    return F.date_add(F.next_day(before, weekday), 7 * (n - 1))


def holidays(years: DataFrame) -> DataFrame:
    """Holiday days of the given ``year`` rows, observed days included.

    A fixed-date holiday on a Saturday is also kept on the Friday before, one on a
    Sunday on the Monday after. The observed New Year's Day may fall into the year before.
    """
    year = F.col("year")
    entries = []
    for name, (month, day, first) in FIXED_HOLIDAYS.items():
        date = F.make_date(year, F.lit(month), F.lit(day))
        observed = F.when(F.dayofweek(date) == 7, F.date_sub(date, 1)).when(
            F.dayofweek(date) == 1, F.date_add(date, 1)
        )
        entries += [_entry(date, name, first), _entry(observed, f"{name} (observed)", first)]
    next_new_year = F.make_date(year + 1, F.lit(1), F.lit(1))
    entries.append(
        _entry(
            F.when(F.dayofweek(next_new_year) == 7, F.date_sub(next_new_year, 1)),
            "New Year's Day (observed)",
            1871,
        )
    )
    for name, (month, weekday, n, first) in FLOATING_HOLIDAYS.items():
        entries.append(_entry(_nth_weekday(year, month, weekday, n), name, first))
    for name, (month, day) in EVES.items():
        entries.append(_entry(F.make_date(year, F.lit(month), F.lit(day)), name, 1))
    found = years.select("year", F.inline(F.array(*entries)))
    return found.filter(F.col("day").isNotNull() & (F.year("day") == F.col("year"))).select("day", "holiday")


def data_years(df: DataFrame, day: str) -> DataFrame:
    """Every year from the first to the last day of the table."""
    span = df.agg(F.min(F.year(F.to_date(day))).alias("lo"), F.max(F.year(F.to_date(day))).alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi")).alias("year"))


def holiday_distances(df: DataFrame, day: str = "FlightDate") -> DataFrame:
    """``DaysToNearestHoliday`` of every distinct day of the table.

    The holidays of the data years (about a dozen a year) form one array that is compared
    with each distinct day, not with each row.
    """
    listed = holidays(data_years(df, day)).agg(F.sort_array(F.collect_set("day"))).scalar()
    days = df.filter(F.col(day).isNotNull()).select(day).distinct()
    away = F.array_min(F.transform(F.col("_list"), lambda h: F.abs(F.datediff(h, F.to_date(day)))))
    return days.withColumn("_list", listed).select(day, away.alias("DaysToNearestHoliday"))


def add_holidays(df: DataFrame, day: str = "FlightDate", known: DataFrame | None = None) -> DataFrame:
    """Adds ``IsHoliday`` and ``DaysToNearestHoliday``."""
    known = holiday_distances(df, day) if known is None else known
    return df.join(known, day, "left").withColumn(
        "IsHoliday", F.coalesce((F.col("DaysToNearestHoliday") == 0).cast("int"), F.lit(0))
    )
