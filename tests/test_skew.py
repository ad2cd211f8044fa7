"""A key holding a third of all flights and a third of all observations: the
pre-aggregated question plans must equal counting the fanned-out mart rows."""

import pytest
from pyspark.sql import functions as F

from windshear.functions.wind import wind_bin
from windshear.plans import direct, queries

LO, HI = "2024-01-01 00:00", "2024-01-03 00:00"


@pytest.fixture(scope="module")
def skewed(spark):
    t0 = F.lit("2024-01-01 00:00").cast("timestamp_ntz")
    key = lambda i: F.when(i % 3 == 0, t0).otherwise(
        F.timestamp_add("MINUTE", (i % 50) * 5, t0))
    i = F.col("id")
    flights = spark.range(3000).select(
        key(i).alias("time_interval"),
        F.when(i % 2 == 0, F.lit("departure")).otherwise(F.lit("arrival")).alias("dep_or_arr"),
        F.concat(F.lit("A"), (i % 4).cast("string")).alias("dep_iata"),
        (i % 4).cast("float").alias("dep_long"), (i % 4 + 30).cast("float").alias("dep_lat"),
        F.timestamp_add("MINUTE", i % 7, key(i)).alias("dep_time"),
        (i % 2).cast("int").alias("dep_del15"),
        F.concat(F.lit("B"), (i % 3).cast("string")).alias("arr_iata"),
        (i % 3).cast("float").alias("arr_long"), (i % 3 + 40).cast("float").alias("arr_lat"),
        F.when(i % 11 != 0, F.timestamp_add("MINUTE", i % 90, key(i))).alias("arr_time"),
        ((i + 1) % 2).cast("int").alias("arr_del15"),
        F.when(i % 7 == 0, F.lit("B")).alias("cncl_code"),
        F.when(i % 5 == 0, F.lit("10.00")).when(i % 5 == 1, F.lit("0.00")).alias("wthr_code"),
        F.when(i % 9 == 0, F.lit("XYZ")).alias("diverted_iata"),
    )
    dirs = F.array(*[F.lit(d) for d in ("N", "NE", "E", "S", "VRB")])
    speed = (F.when(i % 10 == 0, F.lit(None).cast("double"))
             .when(i % 17 == 0, F.lit(-1.0)).otherwise((i % 40) * F.lit(0.5)))
    weather = spark.range(900).select(
        key(i).alias("time_interval"),
        F.when(i % 13 != 0, F.get(dirs, (i % 5).cast("int"))).alias("card_dir"),
        speed.alias("wind_speed"),
        wind_bin(speed).alias("binned_wind"),
        (i % 3).cast("int").alias("crosswind_lim"),
    )
    mart = flights.join(weather, "time_interval", "left")
    return flights, weather, mart


def _same(a, b):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


@pytest.mark.parametrize("direction", ["departure", "arrival"])
def test_wind_rose_under_skew(skewed, direction):
    flights, weather, mart = skewed
    _same(direct.wind_rose(flights, weather, direction, LO, HI), queries.wind_rose(mart, direction, LO, HI))


@pytest.mark.parametrize("direction", ["departure", "arrival"])
@pytest.mark.parametrize("counterpart", [False, True])
def test_delay_count_under_skew(skewed, direction, counterpart):
    flights, weather, mart = skewed
    _same(direct.airport_delay_count(flights, weather, direction, LO, HI, counterpart=counterpart),
          queries.airport_delay_count(mart, direction, LO, HI, counterpart=counterpart))


@pytest.mark.parametrize("direction", ["departure", "arrival"])
def test_crosswind_under_skew(skewed, direction):
    flights, weather, mart = skewed
    got = direct.crosswind_interruptions(flights, weather, direction, LO, HI)
    _same(got, queries.crosswind_interruptions(mart, direction, LO, HI))
    assert sum(r["dry"] + r["precip"] for r in got.collect()) > 0


@pytest.mark.parametrize("hot_rows,chunk", [(50, 7), (1, 1000)])
def test_split_join_equals_left_join(spark, skewed, hot_rows, chunk):
    from windshear.operators.joins import attach_weather_split

    flights, weather, mart = skewed
    # identical copies at the hot key as well
    weather = weather.unionByName(weather.where(F.col("time_interval") == F.lit("2024-01-01 00:00")
                                                .cast("timestamp_ntz")))
    plain = flights.join(weather, "time_interval", "left")
    split = attach_weather_split(flights, weather, hot_key_rows=hot_rows, buckets=4, chunk_rows=chunk)
    assert split.count() == plain.count()
    assert split.exceptAll(plain.select(*split.columns)).count() == 0
    assert plain.select(*split.columns).exceptAll(split).count() == 0


@pytest.mark.parametrize("lim", [1, 2])
def test_interruption_classes_under_skew(skewed, lim):
    from windshear.functions.labels import interruption_class

    flights, weather, mart = skewed
    cond = F.col("crosswind_lim") == lim
    expected = mart.groupBy(interruption_class(cond).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    _same(direct.interruption_classes(flights, weather, cond, "c"), expected)
