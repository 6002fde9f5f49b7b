"""Cleaned legs -> feature table; plans.ingest starts from the raw months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwork import schemas
from legwork.operators import calendar, chain, clean, history, state, weather
from legwork.session import cut_to_table

#: Columns of cleaned legs that are dropped from the table and read by no step after the airport state.
UNREAD = [
    "DepDelay", "ActualElapsedTime", "ArrTime", "DepTime", "ArrDateTime", "DepDateTime", "AirTime", "ArrDelay",
    "SecurityDelay", "TZ_Origin", "TZ_Dest", "CRSDepTime", "CRSArrTime",
]


def feature_table(
    legs: DataFrame,
    airports: DataFrame,
    readings: DataFrame,
    scope: Sequence[str] = tuple(schemas.SCOPE_AIRPORTS),
    min_year: int = 2014,
    keep_keys: bool = False,
) -> DataFrame:
    """All features of the completed legs between listed airports.

    ``legs`` should be a stored table. State and chain see every cleaned leg; history and
    lags see the completed ones only. The chain writes its linked legs once, and
    every lookup table below is derived from those stored rows. The lookup tables are written
    too: Spark then knows their size when it plans the joins, and broadcasts those
    below its threshold instead of shuffling the legs for each. With ``keep_keys`` the
    leg id and day stay in the table. Columns that nothing below reads are left behind before
    the chain, and the flight numbers' history, whose join shuffles the legs, comes before the
    other joins, which widen them.
    """
    chained = chain.add_chain(legs.drop(*UNREAD))
    known = airports.filter(F.col("iata_code").isin(list(scope))).select("iata_code")
    base = clean.training_rows(chained, list(scope), min_year)
    for end in ("Origin", "Dest"):
        base = base.join(known.withColumnRenamed("iata_code", end), end, "left_semi")

    # lookup tables, each an aggregate of a few columns of the base rows
    series = cut_to_table(weather.airport_weather(base, airports.join(known, "iata_code"), readings), "weather")
    days = cut_to_table(calendar.holiday_distances(base), "holidays")
    hours = cut_to_table(state.airport_state(legs, min_year), "state")
    groups = {"airline": "Reporting_Airline", "origin": "Origin", "dest": "Dest", "global": None}
    daily = []
    for prefix, group in groups.items():
        table, columns = history.group_history(base, group, prefix)
        daily.append((group, cut_to_table(table, f"daily-{prefix}"), columns))
    flight = history.add_flight_history(
        base.select(
            "FlightID", "FlightDate", "CRSDepDateTime_UTC", "Reporting_Airline",
            "Flight_Number_Reporting_Airline", schemas.DELAY_COLUMN,
        )
    ).select("FlightID", *history.FLIGHT_HISTORY)

    with_flights = base.join(flight, "FlightID", "left").fillna(0.0, subset=history.FLIGHT_HISTORY)
    rows = state.attach_state(with_flights, hours)
    rows = calendar.add_holidays(rows, known=days)
    rows = weather.attach_weather(rows, series)
    for group, table, columns in daily:
        rows = history.attach_daily(rows, table, group, columns)
    kept = [c for c in rows.columns if c not in history.FLIGHT_HISTORY]
    rows = rows.select("FlightID", *[c for c in kept if c != "FlightID"], *history.FLIGHT_HISTORY).withColumns(
        {"DayOfYear": F.dayofyear("CRSDepDateTime"), "dep_hour": F.hour("CRSDepDateTime")}
    )
    dropped = [c for c in schemas.FEATURE_TABLE_DROPS if not (keep_keys and c in ("FlightID", "FlightDate"))]
    return rows.drop(*dropped)
