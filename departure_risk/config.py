"""Schemas, column lists and constants."""

from pyspark.sql import types as T

# --- Fixed values: the raw layout, thresholds and column names of the data model.

RAW_COLUMNS = [
    "FlightDate", "Reporting_Airline", "Origin", "Dest", "Tail_Number", "CRSDepTime", "CRSArrTime",
    "CRSElapsedTime", "Distance", "DepDelay", "Cancelled", "Diverted",
]

LATE_MINUTES = 15
HISTORY_DAYS = 28
RECENT_DAYS = 7
RECALIBRATION_DAYS = 14
CUBE_AIRPORTS = 30
WEATHER_AIRPORTS = 60
ANSWER_ROWS = 200
OTHER_AIRPORTS = "Other airports"
DAY_PARTS = ["Morning (5-11)", "Midday (11-16)", "Evening (16-21)", "Night (21-5)"]

# Name in the forecast payload -> column name.
WEATHER_COLUMNS = {
    "precipitation_sum": "precip_mm",
    "snowfall_sum": "snow_cm",
    "wind_gusts_10m_max": "gust_kmh",
    "temperature_2m_min": "temp_min_c",
}

# Columns the models read.
SCHEDULE = ["dep_hour", "day_of_week", "month", "distance", "crs_elapsed"]
LOAD = ["origin_day_flights", "origin_hour_flights"]
HISTORY_28D = ["origin_rate", "origin_n", "carrier_rate", "carrier_n", "route_rate", "route_n", "origin_hour_rate", "origin_hour_n"]
HISTORY_7D = ["origin_7d_rate", "carrier_7d_rate", "nation_7d_rate"]
ROTATION = ["leg_number", "legs_that_day", "turnaround_min"]
WEATHER = ["origin_precip_mm", "origin_snow_cm", "origin_gust_kmh", "origin_temp_min_c",
           "dest_precip_mm", "dest_snow_cm", "dest_gust_kmh", "dest_temp_min_c"]

# --- End of fixed values.

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

FLIGHTS_SCHEMA = T.StructType([
    T.StructField("flight_id", T.LongType()),
    T.StructField("flight_date", T.DateType()),
    T.StructField("carrier", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("dest", T.StringType()),
    T.StructField("tail", T.StringType()),
    T.StructField("dep_min", T.IntegerType()),
    T.StructField("arr_min", T.IntegerType()),
    T.StructField("dep_hour", T.IntegerType()),
    T.StructField("crs_elapsed", T.DoubleType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("operated", T.BooleanType()),
    T.StructField("dep_delay", T.DoubleType()),
    T.StructField("delayed", T.IntegerType()),
])

WEATHER_SCHEMA = T.StructType(
    [T.StructField("airport", T.StringType()), T.StructField("date", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in WEATHER_COLUMNS.values()]
)

LABEL = "delayed"
#: The column that dated tables are partitioned by: the day's year and month, 2025-03.
MONTH = "flight_month"
CATEGORICAL = ["carrier", "origin", "dest"]
CELL_KEYS = ["flight_date", "carrier", "origin", "dest", "dep_hour"]

NUMERIC = SCHEDULE + LOAD + HISTORY_28D + HISTORY_7D + ROTATION + WEATHER
MODEL_COLUMNS = CATEGORICAL + NUMERIC

# Ablations: what the model saw before rotation and weather, and before the last-week trend.
ABLATIONS = {
    "base": [c for c in MODEL_COLUMNS if c not in ROTATION + WEATHER + HISTORY_7D],
    "v2": [c for c in MODEL_COLUMNS if c not in HISTORY_7D],
    "full": MODEL_COLUMNS,
}

SNAPSHOT_KEYS = ["carrier", "origin", "dest", "dep_hour"]
SNAPSHOT_MEDIANS = ["distance", "crs_elapsed"] + LOAD
SNAPSHOT_LATEST = HISTORY_28D + HISTORY_7D
