"""Adapters from the benchmark tables to the four raw inputs of the job.

The benchmark data holds no flights or weather, so both are derived with fixed
arithmetic from its tables (the same formulas drive the SQL oracle). The
output has the raw CSV shape: every column is text, and the library's own
operators do all parsing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windshear.config import HubConfig
from windshear.operators.joins import broadcast_if_small, spread

# ---------------------------------------------------------------------------
# Fixed values of the table mapping (must match the SQL oracle).
# ---------------------------------------------------------------------------
FIXTURE_HUB = "N08"
FIXTURE_HUB_TZ = "America/New_York"
# The D9 query leaves this nation out of the airport table, so that a flight end misses it.
MISSING_NATION = 24
FIRST_FLIGHT_DAY = "2024-01-01"
FLIGHT_DAYS = 30
# Every so many orders the next period of flights begins, and events are dealt in turn to a period for so many of them: the
# days grow with the tables, and the rows that share a day or a grid key do not. Ten periods hold both DST changes of 2024.
PERIOD_ORDERS, PERIOD_EVENTS, PERIOD_DAYS = 15_000, 10_000, 34
# Time zone by region key 0-4; the hub's region has the hub's zone.
REGION_ZONES = ("America/Phoenix", "America/Chicago", "America/Denver",
                "America/New_York", "America/Los_Angeles")
# Cardinal direction by event_id % 17.
CARDINALS = ("N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE", "S", "SSW", "SW",
             "WSW", "W", "WNW", "NW", "NNW", "VRB")
# Speeds placed exactly on the bin bounds, by event_id % 7.
BOUND_SPEEDS = (2.57, 5.14, 7.72, 10.29, 12.86, 15.43, 18.01)
# Weather condition by event type (error has none).
CONDITIONS = (("view", "Clear"), ("signup", "Overcast"), ("purchase", "Light Rain"),
              ("error", None), ("click", "Fog"))
# Cancellation code by return flag.
CANCEL_CODES = (("A", "A"), ("N", "B"), ("R", "C"))
# ---------------------------------------------------------------------------

FIXTURE_CONFIG = HubConfig(hub=FIXTURE_HUB, hub_tz=FIXTURE_HUB_TZ)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


_READ: dict[tuple, DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a DataFrame, reused within a session: the file listing and
    footer read happen once, and self-joins of one scan share the exchange.
    The benchmark tables are read-only, so the cached listing stays valid."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), spark.sparkContext.applicationId, path)
    df = _READ.get(key)
    if df is None:
        df = _READ[key] = spark.read.parquet(path)
    return df


def airport_code(key: Column) -> Column:
    """``'N' || lpad(key, 2, '0')``."""
    return F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0"))


def _text(c: Column) -> Column:
    return c.cast("string")


def _cents(c: Column) -> Column:
    """An integer with ``.00`` appended, as the flight files write numbers."""
    return F.concat(_text(c), F.lit(".00"))


def _r2(x: Column) -> Column:
    """Round half up to 2 decimals with double arithmetic only."""
    return (F.floor(x * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)).cast("double")


_PERIODS: dict[tuple, int] = {}


def _periods(spark: SparkSession, sf_dir: str) -> int:
    """The number of periods that the events fill, from their number (counted once in a session)."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _PERIODS:
        _PERIODS[key] = max(1, read_table(spark, sf_dir, "events").count() // PERIOD_EVENTS)
    return _PERIODS[key]


def flight_raw(spark: SparkSession, sf_dir: str, limit_bytes: int = 64 << 20) -> DataFrame:
    """S1 stand-in: one flight per line item (lineitem x orders x customer x supplier)."""
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"), "l_orderkey")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
         .join(broadcast_if_small(customer, limit_bytes), F.col("o_custkey") == F.col("c_custkey"))
         .join(broadcast_if_small(supplier, limit_bytes), F.col("l_suppkey") == F.col("s_suppkey")))

    pk, sk, ln, q = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"), F.col("l_quantity")
    cancelled = pk % 20 == 0
    whole_q = F.floor(q)
    flag = F.col("l_returnflag")
    cancel_code = None
    for rf, code in CANCEL_CODES:
        cancel_code = F.when(flag == rf, F.lit(code)) if cancel_code is None else cancel_code.when(flag == rf, F.lit(code))
    day = ((F.col("l_orderkey") + 7 * ln) % FLIGHT_DAYS + F.floor(F.col("l_orderkey") / PERIOD_ORDERS) * PERIOD_DAYS).cast("int")
    origin = airport_code(F.col("s_nationkey"))
    return j.select(
        _text(F.date_add(F.lit(FIRST_FLIGHT_DAY).cast("date"), day)).alias("FlightDate"),
        F.concat(F.lit("C"), _text(sk % 10)).alias("Reporting_Airline"),
        origin.alias("Origin"),
        F.when(cancelled, F.lit(None).cast("string"))
         .when(pk % 41 == 1, F.lit("2400"))
         .otherwise(_text((pk % 24) * 100 + (sk * 7 + ln * 11) % 60)).alias("DepTime"),
        F.when(~cancelled, _cents(whole_q - 20)).alias("DepDelay"),
        F.when(~cancelled, F.when(q >= 35, F.lit("1.00")).otherwise(F.lit("0.00"))).alias("DepDel15"),
        airport_code(F.col("c_nationkey")).alias("Dest"),
        F.when(~cancelled, _text(((pk + 2) % 24) * 100 + (sk * 7 + ln * 13) % 60)).alias("ArrTime"),
        F.when(~cancelled, _cents(whole_q - 25)).alias("ArrDelay"),
        F.when(~cancelled, F.when(q >= 40, F.lit("1.00")).otherwise(F.lit("0.00"))).alias("ArrDel15"),
        _cents(F.col("l_orderkey") % 2500).alias("Distance"),
        F.when(cancelled, cancel_code).alias("CancellationCode"),
        F.when(q >= 35, F.when(flag == "R", F.lit("0.00")).otherwise(_cents(whole_q))).alias("WeatherDelay"),
        _cents(ln).alias("LateAircraftDelay"),
        F.when(pk % 97 == 0, origin).alias("Div1Airport"),
    )


def weather_raw(spark: SparkSession, sf_dir: str, *, descriptor_every: int | None = None) -> DataFrame:
    """S2 stand-in: one station observation per event.

    ``descriptor_every=k`` blanks ``Date_Time`` where ``event_id % k = 0``, the
    shape of the descriptor rows a station file starts with (for F1).
    """
    e = spread(read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value"), "event_id")
    eid, ts, v = F.col("event_id"), F.col("ts"), F.col("value")
    # Built from the wall-clock fields, so the text does not depend on the session zone.
    five = F.lpad(_text(F.floor(F.minute(ts) / 5) * 5), 2, "0")
    date = F.date_add(F.to_date(ts), (eid % _periods(spark, sf_dir) * PERIOD_DAYS).cast("int"))
    stamp = F.concat(_text(date), F.lit("T"), F.lpad(_text(F.hour(ts)), 2, "0"), F.lit(":"),
                     five, F.lit(":00Z"))
    if descriptor_every:
        stamp = F.when(eid % descriptor_every != 0, stamp)
    cardinal = F.get(F.array(*[F.lit(d) for d in CARDINALS]), (eid % len(CARDINALS)).cast("int"))
    bound = F.get(F.array(*[F.lit(s) for s in BOUND_SPEEDS]), (eid % len(BOUND_SPEEDS)).cast("int"))
    scaled = v / F.lit(10.0)
    speed = (F.when(eid % 50 == 0, F.lit(None).cast("double"))
             .when(eid % 11 == 0, bound)
             .otherwise(_r2(scaled)))
    gust = F.when(eid % 3 == 0, _r2(scaled + F.lit(2.0)))
    cond = None
    for et, word in CONDITIONS:
        val = F.lit(word) if word is not None else F.lit(None).cast("string")
        cond = F.when(F.col("event_type") == et, val) if cond is None else cond.when(F.col("event_type") == et, val)
    return e.select(
        stamp.alias("Date_Time"),
        cardinal.alias("wind_cardinal_direction_set_1d"),
        _text((eid * 37) % 360).alias("wind_direction_set_1"),
        _text(speed).alias("wind_speed_set_1"),
        _text(gust).alias("wind_gust_set_1"),
        cond.alias("weather_condition_set_1d"),
    )


def airport_raw(spark: SparkSession, sf_dir: str, *, missing: int | None = None) -> DataFrame:
    """S3 stand-in: one airport per nation (but for nation ``missing``); integer coordinates as text."""
    n = F.col("n_nationkey")
    nations = read_table(spark, sf_dir, "nation")
    if missing is not None:
        nations = nations.where(n != missing)
    return nations.select(
        airport_code(n).alias("iata"),
        F.col("n_name").alias("airport"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.lit("USA").alias("country"),
        _text(n + 25).alias("lat"),
        _text(-(n * 2 + 70)).alias("long"),
        F.lit(None).cast("string").alias("cnt"),
    )


def timezone_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 stand-in: the zone of each airport, by region."""
    zone = F.get(F.array(*[F.lit(z) for z in REGION_ZONES]), F.col("n_regionkey"))
    return read_table(spark, sf_dir, "nation").select(airport_code(F.col("n_nationkey")).alias("iata_code"),
                                          zone.alias("timezone"))


def raw_inputs(spark: SparkSession, sf_dir: str, **weather_kw) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``(flights, weather, airports, zones)`` in raw CSV shape."""
    return (flight_raw(spark, sf_dir), weather_raw(spark, sf_dir, **weather_kw),
            airport_raw(spark, sf_dir), timezone_raw(spark, sf_dir))
