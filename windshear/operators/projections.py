"""Column selection, renaming and typing."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windshear.functions.casts import to_date, to_double, to_float, to_int, to_timestamp_ntz
from windshear.schemas import MART


def flight_columns(raw: DataFrame) -> DataFrame:
    """The 15 flight columns, renamed; date and five integers parsed.

    Clock times stay text here; they are parsed by C1/C2.
    """
    return raw.select(
        to_date("FlightDate").alias("date"),
        F.col("Reporting_Airline").alias("airline_id"),
        F.col("Origin").alias("dep_iata"),
        F.col("DepTime").alias("dep_time"),
        to_int("DepDelay").alias("dep_delay"),
        to_int("DepDel15").alias("dep_del15"),
        F.col("Dest").alias("arr_iata"),
        F.col("ArrTime").alias("arr_time"),
        to_int("ArrDelay").alias("arr_delay"),
        to_int("ArrDel15").alias("arr_del15"),
        to_int("Distance").alias("distance"),
        F.col("CancellationCode").alias("cncl_code"),
        F.col("WeatherDelay").alias("wthr_code"),
        F.col("LateAircraftDelay").alias("late_arr_code"),
        F.col("Div1Airport").alias("diverted"),
    )


def weather_columns(raw: DataFrame) -> DataFrame:
    """F1 + P2: drop descriptor rows (no ``Date_Time``), then the 6 weather columns.

    The time is read as wall-clock UTC (D21); speeds stay double (D4).
    """
    return raw.dropna(how="any", subset=["Date_Time"]).select(
        to_timestamp_ntz("Date_Time").alias("time_interval"),
        F.col("wind_cardinal_direction_set_1d").alias("card_dir"),
        to_int("wind_direction_set_1").alias("wind_dir"),
        to_double("wind_speed_set_1").alias("wind_speed"),
        to_double("wind_gust_set_1").alias("gust_speed"),
        F.col("weather_condition_set_1d").cast("string").alias("precip"),
    )


def airport_columns(raw: DataFrame) -> DataFrame:
    """Airport code, latitude and longitude (text until the mart casts them)."""
    return raw.select(F.col("iata").alias("iata_code"), F.col("lat"), F.col("long"))


def timezone_columns(raw: DataFrame) -> DataFrame:
    """Airport code and IANA zone name; a name that is no zone becomes NULL (then D9
    applies), so that one bad row does not fail the job."""
    zone = F.col("timezone").cast("string")
    known = known_zones()
    return raw.select(F.col("iata_code").cast("string"), F.when(zone.isin(known), zone).alias("timezone"))


@cache
def known_zones() -> list[str]:
    """The region names that the JVM's time-zone database knows."""
    jvm = SparkContext._active_spark_context._jvm
    return sorted(jvm.java.lang.String.join(",", jvm.java.time.ZoneId.getAvailableZoneIds()).split(","))


def airport_role(dim: DataFrame, role: str) -> DataFrame:
    """P5: the airport dimension playing the ``dep`` or ``arr`` role."""
    if role not in ("dep", "arr"):
        raise ValueError(f"role must be 'dep' or 'arr', not {role!r}")
    return dim.select(
        F.col("iata_code").alias(f"{role}_iata"),
        F.col("lat").alias(f"{role}_lat"),
        F.col("long").alias(f"{role}_long"),
        F.col("timezone").alias(f"{role}_timezone"),
    )


_FLOAT_TEXT = {"dep_long", "dep_lat", "arr_long", "arr_lat"}


def _mart_column(name: str, dtype) -> F.Column:
    if name in _FLOAT_TEXT:
        return to_float(name).alias(name)
    if name == "diverted":
        # The column holds an airport code; as an integer it is NULL, never an error.
        return to_int(name).alias(name)
    return F.col(name).cast(dtype).alias(name)


def mart_projection(df: DataFrame, *, with_diverted_iata: bool = False) -> DataFrame:
    """The 24 mart columns in order, with their final types."""
    cols = [_mart_column(f.name, f.dataType) for f in MART.fields]
    if with_diverted_iata:
        cols.append(F.col("diverted").cast("string").alias("diverted_iata"))
    return df.select(*cols)


FLIGHT_SIDE = tuple(
    f.name for f in MART.fields
    if f.name not in {"card_dir", "wind_dir", "wind_speed", "binned_wind", "crosswind", "crosswind_lim"}
)


def flight_side_projection(df: DataFrame, *extra: str) -> DataFrame:
    """The flight half of P6 (18 columns) plus the join key and ``extra`` columns."""
    types = {f.name: f.dataType for f in MART.fields}
    return df.select(*[_mart_column(n, types[n]) for n in FLIGHT_SIDE], "time_interval", *extra)


@dataclass(frozen=True)
class RoleColumns:
    iata: str
    long: str
    lat: str
    time: str
    del15: str


def role_columns(direction: str) -> RoleColumns:
    """The mart columns a ``departure`` or ``arrival`` question reads.

    D18: any other value is an error rather than an unbound name.
    """
    if direction == "departure":
        p = "dep"
    elif direction == "arrival":
        p = "arr"
    else:
        raise ValueError(f"direction must be 'departure' or 'arrival', not {direction!r}")
    return RoleColumns(f"{p}_iata", f"{p}_long", f"{p}_lat", f"{p}_time", f"{p}_del15")


def other_role(direction: str) -> RoleColumns:
    return role_columns("arrival" if role_columns(direction).iata.startswith("dep") else "departure")
