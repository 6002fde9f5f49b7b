"""The feature table, from cleaned legs and from raw monthly files."""

from pyspark.sql import functions as F

from legwork.plans import features, ingest
from legwork.registry.base import CTES, ENTRIES, TS, legs, query, rounded, sql, staged, text
from legwork.registry.calendar import HOLIDAY_SQL
from legwork.registry.history import group_sql, hist_names
from legwork.registry.storage import written_months
from legwork.schemas import RAW_LEG_TYPES
from legwork.session import scratch_path
from legwork.sources import views

# imported for their statements, which are the parts below
from legwork.registry import chain, state  # noqa: F401  isort: skip

_GROUPS = {"airline": "Reporting_Airline", "origin": "Origin", "dest": "Dest"}
_PARTS = [
    "prev_leg_known_delay", "turnaround", "legs_per_day", "day_so_far_dep", "day_so_far_arr",
    "day_so_far_landed", "weather_join", "lag_delay_global", "hist_flight_median",
]
_FLAGS = ["FirstFlightRecord", "has_prev_flight", "Same_day_previous_flight", "is_Return_flight"]
_PLAIN = ["Reporting_Airline", "Origin", "Dest", "FlightDate", "DayofMonth", "DayOfWeek", "Year", "Month", "DistanceGroup"]
_NUMBERS = ["ArrDelayMinutes", "CRSElapsedTime", "Distance"]
_MOMENTS = [
    "CRSDepDateTime", "CRSArrDateTime", "CRSDepDateTime_UTC", "UTC_CRS_FlightDate", "Information_time_UTC",
    "Information_time", "floor_informationtime_UTC", "floor_informationtime",
]


def _feature_sql() -> str:
    """The statements of the parts, joined by leg."""
    parts = [ENTRIES[name].sql for name in _PARTS]
    parts.append(f"SELECT FlightID, {', '.join(_FLAGS)} FROM ({ENTRIES['prev_leg_chain'].sql})")
    parts.append(HOLIDAY_SQL)
    for prefix, group in _GROUPS.items():
        lags = [f"{prefix}_yesterday_delay", f"{prefix}_lastweek_delay"]
        parts.append(group_sql(f"by_{prefix}", prefix, group, hist_names(prefix) + lags))
    own = ", ".join(
        [f'"{c}"' for c in _PLAIN]
        + [f"round({c}, 6) AS {c}" for c in _NUMBERS]
        + [f"strftime({c}, {TS}) AS {c}" for c in _MOMENTS]
    )
    base = sql(["train"], f"""
SELECT FlightID, {own}, CAST(dayofyear(CRSDepDateTime) AS INTEGER) AS DayOfYear, CAST(hour(CRSDepDateTime) AS INTEGER) AS dep_hour
FROM train""")
    joined = "\n".join(f"JOIN ({p}) USING (FlightID)" for p in parts)
    return f"SELECT * FROM ({base})\n{joined}"


def _shown(table):
    """All columns in the form of the twin: numbers rounded, moments as text."""
    kinds = dict(table.dtypes)
    counts = ["total_Flights_scheduled_today", "Flights_before_today"]
    wide = [c for c, kind in kinds.items() if kind == "double" or c in counts]
    kept = [c for c in table.columns if c not in wide and c not in _MOMENTS]
    return table.select(*kept, *rounded(*wide), *[text(c).alias(c) for c in _MOMENTS])


def build_features(spark, d):
    return features.feature_table(
        legs(spark, d), views.airports(spark, d), views.station_weather(spark, d),
        views.VIEW_SCOPE_AIRPORTS, min_year=2014, keep_keys=True,
    )


def feature_rows(spark, d):
    """The feature table, read from the table that the feature job writes."""
    return staged(spark, d, "features", lambda: build_features(spark, d))


@query("feature_table", _feature_sql())
def feature_table(spark, d):
    return _shown(build_features(spark, d))


_FIRST = ["FlightDate", "CRSDepTime", "Reporting_Airline", "Flight_Number_Reporting_Airline"]
_ORDER = ", ".join(f'"{c}" NULLS FIRST' for c in _FIRST + [c for c in RAW_LEG_TYPES if c not in _FIRST])


def _numbered(statement: str) -> str:
    """The statement over the records in scope, numbered by their order."""
    whole = f"raw AS ({CTES['raw']}\n)"
    touches = " OR ".join(f"{end} IN {tuple(views.VIEW_SCOPE_AIRPORTS)}" for end in ("Origin", "Dest"))
    return statement.replace(whole, f"all_{whole},\nraw AS ({_renumbered(touches)})")


def _renumbered(touches: str) -> str:
    return f"""
SELECT * REPLACE (row_number() OVER (ORDER BY {_ORDER}) - 1 AS FlightID) FROM all_raw
WHERE Reporting_Airline IN {tuple(views.VIEW_SCOPE_AIRLINES)} AND ({touches})"""


@query("raw_to_features", _numbered(_feature_sql()))
def raw_to_features(spark, d):
    root, years = written_months(spark, d)
    return _shown(ingest.months_to_features(
        spark, root, years, views.airports(spark, d), views.station_weather(spark, d), scratch_path(spark, "clean_legs"),
        airlines=views.VIEW_SCOPE_AIRLINES, scope=views.VIEW_SCOPE_AIRPORTS, keep_keys=True,
    ))
