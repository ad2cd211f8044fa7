"""Static schemas: raw CSV inputs (all strings, as the files are read) and the mart."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Flight CSV columns the job uses.
FLIGHT_RAW = _strings(
    "FlightDate", "Reporting_Airline", "Origin", "DepTime", "DepDelay", "DepDel15",
    "Dest", "ArrTime", "ArrDelay", "ArrDel15", "Distance", "CancellationCode",
    "WeatherDelay", "LateAircraftDelay", "Div1Airport",
)

# Weather station CSV columns the job uses.
WEATHER_RAW = _strings(
    "Date_Time", "wind_cardinal_direction_set_1d", "wind_direction_set_1",
    "wind_speed_set_1", "wind_gust_set_1", "weather_condition_set_1d",
)

# S3: airport dimension CSV.
AIRPORT_RAW = _strings("iata", "airport", "city", "state", "country", "lat", "long", "cnt")

# Airport time-zone CSV.
TIMEZONE_RAW = _strings("iata_code", "timezone")

# The published mart, 24 columns in order.
MART = T.StructType([
    T.StructField("dep_or_arr", T.StringType()),
    T.StructField("dep_iata", T.StringType()),
    T.StructField("dep_long", T.FloatType()),
    T.StructField("dep_lat", T.FloatType()),
    T.StructField("dep_time", T.TimestampNTZType()),
    T.StructField("dep_delay", T.IntegerType()),
    T.StructField("dep_del15", T.IntegerType()),
    T.StructField("arr_iata", T.StringType()),
    T.StructField("arr_long", T.FloatType()),
    T.StructField("arr_lat", T.FloatType()),
    T.StructField("arr_time", T.TimestampNTZType()),
    T.StructField("arr_delay", T.IntegerType()),
    T.StructField("arr_del15", T.IntegerType()),
    T.StructField("distance", T.IntegerType()),
    T.StructField("diverted", T.IntegerType()),
    T.StructField("cncl_code", T.StringType()),
    T.StructField("late_arr_code", T.StringType()),
    T.StructField("wthr_code", T.StringType()),
    T.StructField("card_dir", T.StringType()),
    T.StructField("wind_dir", T.IntegerType()),
    T.StructField("wind_speed", T.FloatType()),
    T.StructField("binned_wind", T.StringType()),
    T.StructField("crosswind", T.IntegerType()),
    T.StructField("crosswind_lim", T.IntegerType()),
])

MART_COLUMNS = tuple(f.name for f in MART.fields)
