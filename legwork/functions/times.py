"""Clock times, zones and hour marks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minutes_of_hhmm(hhmm: Column) -> Column:
    """HHMM number -> minute of the day; 2400 is midnight, an invalid time is null."""
    number = hhmm.cast("int")
    hours = F.floor(number / 100).cast("int")
    minutes = number % 100
    return (
        F.when(number == 2400, F.lit(0))
        .when((number >= 0) & (hours < 24) & (minutes < 60), hours * 60 + minutes)
    )


def clock_text(minute_of_day: Column) -> Column:
    """Minute of the day -> ``HH:MM``."""
    hours = F.floor(minute_of_day / 60).cast("int").cast("string")
    minutes = (minute_of_day % 60).cast("int").cast("string")
    return F.concat(F.lpad(hours, 2, "0"), F.lit(":"), F.lpad(minutes, 2, "0"))


def interval(days=0, hours=0, minutes=0) -> Column:
    """A day-time interval from column or literal parts."""
    def part(x):
        return x if isinstance(x, Column) else F.lit(x)
    return F.make_dt_interval(part(days), part(hours), part(minutes))


def plus_minutes(ts: Column, minutes: Column) -> Column:
    """``ts`` moved by a (possibly null) number of whole minutes."""
    return ts + interval(minutes=minutes.cast("int"))


def local_timestamp(day: Column, minute_of_day: Column) -> Column:
    """Date text and minute of the day -> local wall-clock timestamp."""
    midnight = F.to_date(day, "yyyy-MM-dd").cast("timestamp_ntz")
    return plus_minutes(midnight, minute_of_day)


def _by_zone(function: str, ts: str, zone: str) -> Column:
    """Conversion by the row's zone; an unknown zone name fails, a null one gives null."""
    return F.expr(f"cast({function}(cast(`{ts}` as timestamp), `{zone}`) as timestamp_ntz)")


def to_utc(local: str, zone: str) -> Column:
    """Local wall clock -> UTC wall clock, by column names; the session zone must be UTC.

    In the autumn fold the daylight-saving reading is taken. A time in the spring gap
    comes out as if the gap did not exist; ``leave_gap`` moves it to the end of the gap.
    """
    return _by_zone("to_utc_timestamp", local, zone)


def from_utc(utc: str, zone: str) -> Column:
    return _by_zone("from_utc_timestamp", utc, zone)


def leave_gap(utc: str, local: str, zone: str) -> Column:
    """Corrects a converted time whose wall clock does not exist to the first valid instant."""
    into_gap = F.col(local) - F.date_trunc("HOUR", local).cast("timestamp_ntz")
    exists = from_utc(utc, zone) == F.col(local)
    return F.when(exists, F.col(utc)).when(F.col(utc).isNotNull(), F.col(utc) - into_gap)


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("HOUR", ts).cast("timestamp_ntz")


def ceil_hour(ts: Column) -> Column:
    """The next full hour; an exact hour stays."""
    almost_an_hour = F.make_dt_interval(mins=F.lit(59), secs=F.lit(59.999999).cast("decimal(18,6)"))
    return F.date_trunc("HOUR", ts + almost_an_hour).cast("timestamp_ntz")


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def minutes_between(start: Column, end: Column) -> Column:
    """Fractional minutes from ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", start, end) / F.lit(60.0)


def shift_month(year: Column, month: Column) -> Column:
    """First day of the month after (year, month)."""
    return F.add_months(F.make_date(year, month, F.lit(1)), 1)


def week_label(day: Column) -> Column:
    """The Sunday that closes the week of ``day``."""
    return F.next_day(F.date_sub(day, 1), "SUN")
