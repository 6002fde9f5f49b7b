"""Table schemas, column roles and constants."""

from __future__ import annotations

# --- Fixed values: raw leg columns, in file order, with their types -------------------
RAW_LEG_TYPES = {
    "Year": "bigint",
    "Month": "bigint",
    "DayofMonth": "bigint",
    "DayOfWeek": "bigint",
    "FlightDate": "string",
    "Reporting_Airline": "string",
    "Tail_Number": "string",
    "Flight_Number_Reporting_Airline": "bigint",
    "Origin": "string",
    "Dest": "string",
    "CRSDepTime": "bigint",
    "DepTime": "double",
    "DepDelay": "double",
    "DepDelayMinutes": "double",
    "CRSArrTime": "bigint",
    "ArrTime": "double",
    "ArrDelay": "double",
    "ArrDelayMinutes": "double",
    "Cancelled": "double",
    "Diverted": "double",
    "CRSElapsedTime": "double",
    "ActualElapsedTime": "double",
    "AirTime": "double",
    "Distance": "double",
    "DistanceGroup": "bigint",
    "CarrierDelay": "double",
    "WeatherDelay": "double",
    "NASDelay": "double",
    "SecurityDelay": "double",
    "LateAircraftDelay": "double",
}

# --- Fixed values: airports and airlines in scope --------------------------------------
SCOPE_AIRPORTS = [
    "JFK", "LAX", "MIA", "SFO", "EWR", "ORD", "ATL", "DFW", "IAH", "BOS", "MCO", "FLL",
    "SEA", "CLT", "DEN", "PHL", "LAS", "HNL", "DTW", "MSP", "PHX", "LGA", "TPA", "SLC",
    "BWI", "AUS", "SAN", "HOU", "PDX", "MDW", "OAK", "BNA", "DCA", "STL", "DAL",
]
SCOPE_AIRLINES = ["AS", "AA", "DL", "F9", "B6", "WN", "UA"]

# --- Fixed values: delay classes (right-closed upper bounds in minutes) -----------------
DELAY_CLASSES = ["no_delay", "small_delay", "medium_delay", "large_delay"]
DELAY_UPPER_BOUNDS = [15, 60, 180]
FIXED_CLASS_WEIGHTS = {0: 0.3, 1: 0.7, 2: 1.0, 3: 1.5}

# --- Fixed values: split threshold, cutoff, weather -------------------------------------
TIME_THRESHOLD = "2019-01-01 00:00:00"
HOURS_BEFORE = 2
WEATHER_PARAMS = ["temp", "prcp", "wspd", "rhum"]
MAX_STATION_DISTANCE_M = 50_000

# --- Fixed values: column roles of the feature table ------------------------------------
TIME_COLUMN = "CRSDepDateTime_UTC"
TARGET_COLUMN = "delay_class"
DELAY_COLUMN = "ArrDelayMinutes"

NOT_FEATURES = [
    "Information_time_UTC",
    "floor_informationtime_UTC",
    "UTC_CRS_FlightDate",
    "Information_time",
    "floor_informationtime",
    "CRSDepDateTime_UTC",
    "UTC_CRS_ARRFlightDate",
    "UTC_ARRFlightDate",
    "route_delay",
    "dep_hour",
    "ArrDelayMinutes",
]
TIME_OF_DAY_COLUMNS = ["CRSDepDateTime", "CRSArrDateTime"]
ONE_HOT_COLUMNS = ["Reporting_Airline", "Origin", "Dest"]
PREVIOUS_LEG_NUMERIC = [
    "DaysToNearestHoliday",
    "Distance",
    "LateAircraftDelay_prev_flight_delay_info",
    "WeatherDelay_prev_flight_delay_info",
    "NASDelay_prev_flight_delay_info",
    "CarrierDelay_prev_flight_delay_info",
]
WEATHER_NUMERIC = [
    "temp_DEP", "temp_ARR", "prcp_DEP", "prcp_ARR",
    "wspd_DEP", "wspd_ARR", "rhum_DEP", "rhum_ARR",
]
HISTORY_NUMERIC = [
    "hist_airline_delay", "hist_airline_delay_7d", "hist_airline_delay_30d",
    "hist_origin_delay", "hist_origin_delay_7d", "hist_origin_delay_30d",
    "hist_dest_delay", "hist_dest_delay_7d", "hist_dest_delay_30d",
    "hist_flg_delay", "hist_flg_delay_30d",
    "hist_flg_median_delay", "hist_flg_median_delay_30d",
    "hist_flg_count_delay", "hist_flg_count_delay_30d",
]
LAG_NUMERIC = [
    "origin_yesterday_delay", "origin_lastweek_delay",
    "dest_yesterday_delay", "dest_lastweek_delay",
    "airline_yesterday_delay", "airline_lastweek_delay",
    "global_yesterday_delay", "global_lastweek_delay",
]
DAY_SO_FAR_NUMERIC = [
    "R_dep_cum_count_sfd", "R_dep_cum_DepDelayMinutes_sfd",
    "R_dep_count_fligts_lh", "R_dep_avg_DepDelayMinutes_lh",
    "R_arr_origin_cum_count_sfd",
    "R_arr_origin_cum_ArrDelayMinutes_sfd", "R_arr_origin_avg_ArrDelayMinutes_sfd",
    "R_arr_origin_cum_WeatherDelay_sfd", "R_arr_origin_avg_WeatherDelay_sfd",
    "R_arr_origin_cum_NASDelay_sfd", "R_arr_origin_avg_NASDelay_sfd",
    "R_arr_origin_count_fligts_lh", "R_arr_origin_avg_ArrDelayMinutes_lh",
    "R_arr_origin_avg_WeatherDelay_lh", "R_arr_origin_avg_NASDelay_lh",
    "R_dest_arrived_cum_count_sfd", "R_dest_arrived_cum_ArrDelayMinutes_sfd",
    "R_dest_arrived_avg_ArrDelayMinutes_sfd", "R_dest_arrived_cum_NASDelay_sfd",
    "R_dest_arrived_avg_NASDelay_sfd", "R_dest_arrived_count_fligts_lh",
    "R_dest_arrived_avg_ArrDelayMinutes_lh", "R_dest_arrived_avg_NASDelay_lh",
]
UNSCALED_NUMERIC = [
    "Prev_flight_DelayMinutes", "Expected_Tournaround_time",
    "DayOfYear", "CRSTurnaroundTime",
    "DistanceGroup", "Year", "Month",
    "DayOfWeek", "DayofMonth", "CRSElapsedTime",
    "Time_since_last_certified_record", "Flights_before_today",
    "total_Flights_scheduled_today", "R_dep_avg_DepDelayMinutes_sfd",
]
FLAG_COLUMNS = [
    "has_prev_flight", "IsHoliday", "FirstFlightRecord",
    "is_Return_flight", "Prev_flight_has_departed", "Same_day_previous_flight",
]
THREE_VALUED_COLUMNS = ["Airplane_already_at_airport"]
RULE_FEATURE = "R_dep_avg_DepDelayMinutes_sfd"

# --- Fixed values: columns that leak the outcome ----------------------------------------
LEAKAGE_COLUMNS = [
    "ArrDelay", "ArrDelayMinutes", "ArrDel15", "ArrivalDelayGroups", "ArrTime",
    "ActualElapsedTime", "AirTime",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
    "DepDelay", "DepDelayMinutes", "DepDel15", "DepartureDelayGroups", "DepTime",
    "TaxiOut", "WheelsOff", "WheelsOn", "TaxiIn",
    "Cancelled", "CancellationCode", "Diverted",
]
# --- Fixed values: columns dropped when the feature table is written, by kind -----------
TARGET_LIKE_COLUMNS = [
    "DepDelay", "DepDelayMinutes", "ActualElapsedTime", "Diverted", "Cancelled",
    "ArrTime", "DepTime", "ArrDateTime", "DepDateTime", "AirTime",
    "NASDelay", "SecurityDelay", "LateAircraftDelay", "CarrierDelay", "WeatherDelay",
    "ArrDateTime_UTC", "ArrDelay",
]
ZONE_COLUMNS = ["TZ_Origin", "TZ_Dest"]
TIMESTAMP_COLUMNS = [
    "DepDateTime_UTC", "CRSArrDateTime_UTC", "CRSDepTime", "CRSArrTime", "FlightDate",
]
OVERFIT_COLUMNS = ["FlightID", "Tail_Number", "Flight_Number_Reporting_Airline"]
LEG_INFO_COLUMNS = [
    "Origin", "Dest", "Reporting_Airline", "Tail_Number",
    "Flight_Number_Reporting_Airline", "FlightID",
]
TIME_INFO_COLUMNS = [
    "CRSDepDateTime", "CRSArrDateTime", "CRSDepDateTime_UTC", "CRSArrDateTime_UTC",
    "knownWeatherDateTime_UTC", "Year", "Month", "DayofMonth", "DayOfWeek", "DayOfYear",
]
WEATHER_INFO_COLUMNS = [
    "temp_ARR", "prcp_ARR", "wspd_ARR", "temp_DEP", "prcp_DEP", "wspd_DEP",
]
REAL_TIME_COLUMNS = ["prev_AvgArrDelay", "avg_delay"]
# --- Fixed values: columns that may hold nulls on completed legs ------------------------
NULLS_ALLOWED = [
    "Tail_Number", "TurnaroundTime", "NASDelay", "SecurityDelay",
    "LateAircraftDelay", "CarrierDelay", "WeatherDelay",
]

# --- Fixed values: stream language -> countries that speak it ----------------------------
LANGUAGE_COUNTRIES = {
    "EN": ["USA", "GBR", "CAN", "AUS", "IRL", "NZL", "ZAF"],
    "DE": ["DEU", "AUT", "CHE"],
    "FR": ["FRA", "BEL", "CHE", "CAN"],
    "ES": ["ESP", "MEX", "ARG", "COL", "CHL", "PER", "VEN", "ECU", "BOL"],
    "RU": ["RUS", "UKR", "BLR"],
    "ZH": ["CHN", "TWN", "SGP"],
    "PT": ["BRA", "PRT"],
    "JA": ["JPN"],
    "IT": ["ITA"],
    "KO": ["KOR"],
    "PL": ["POL"],
    "SV": ["SWE"],
    "TR": ["TUR"],
    "NL": ["NLD", "BEL"],
    "FI": ["FIN"],
    "TH": ["THA"],
    "CS": ["CZE"],
    "DA": ["DNK"],
    "HU": ["HUN"],
    "NO": ["NOR"],
}

SCALED_COLUMNS = (
    TIME_OF_DAY_COLUMNS + PREVIOUS_LEG_NUMERIC + WEATHER_NUMERIC
    + HISTORY_NUMERIC + LAG_NUMERIC + DAY_SO_FAR_NUMERIC
)
FEATURE_COLUMNS = (
    ONE_HOT_COLUMNS + SCALED_COLUMNS + UNSCALED_NUMERIC + FLAG_COLUMNS + THREE_VALUED_COLUMNS
)
FEATURE_TABLE_DROPS = TARGET_LIKE_COLUMNS + ZONE_COLUMNS + TIMESTAMP_COLUMNS + OVERFIT_COLUMNS


def ddl(types: dict[str, str]) -> str:
    """A schema string from a name -> type mapping."""
    return ", ".join(f"`{name}` {kind}" for name, kind in types.items())


RAW_LEG_SCHEMA = ddl(RAW_LEG_TYPES)
NON_NULL_LEG_COLUMNS = [n for n, t in RAW_LEG_TYPES.items() if t == "bigint"]
WEATHER_SCHEMA = ddl(
    {"airport": "string", "timestamp": "timestamp_ntz", **{p: "double" for p in WEATHER_PARAMS}}
)
EDGE_SCHEMA = "src_id bigint, target_id bigint"
NODE_SCHEMA = (
    "id bigint, dead_account int, language string, affiliate_status int, explicit_content int, "
    "creation_date date, last_stream date, view_count bigint, account_lifetime bigint"
)
MESSAGE_SCHEMA = "src bigint, dst bigint, unix_ts bigint"
METRIC_SCHEMA = "run_id string, model_name string, split string, metric string, value double"


def check_columns(names: list[str]) -> dict[str, list[str]]:
    """Recorded columns that are absent and present columns nobody recorded."""
    recorded = set(FEATURE_COLUMNS) | {TARGET_COLUMN} | set(NOT_FEATURES)
    present = set(names)
    return {"missing": sorted(recorded - present), "extra": sorted(present - recorded)}
