"""The published mart: atomic overwrite, day rebuilds, zone map, factors, rollups; quarantine, stable keys, weights."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from windshear import schemas
from windshear.config import HubConfig
from windshear.operators import aggregates
from windshear.operators.joins import dimension_fits
from windshear.operators.keys import stable_key
from windshear.plans import etl, queries, rebuild, rollups
from windshear.sources import factored, files, mart as store, versions
from windshear.sources.fixtures import FIXTURE_CONFIG as CFG
from windshear.sources.fixtures import raw_inputs

LO, HI = dt.datetime(2024, 1, 8, 6, 30), dt.datetime(2024, 1, 15, 18, 45)


@pytest.fixture(scope="module")
def inputs(spark):
    return raw_inputs(spark, SF_SMALL)


@pytest.fixture(scope="module")
def mart(spark, inputs, tmp_path_factory):
    """The sf0.001 mart, computed once."""
    path = str(tmp_path_factory.mktemp("mart") / "m")
    etl.build_mart(*inputs, CFG).write.parquet(path)
    return spark.read.parquet(path)


def rows(df):
    return sorted(map(str, df.collect()))


def names(found):
    """File names below the mart's folder, whichever way their address is written."""
    return {f.split("/m/", 1)[1] for f in found}


def test_a_failed_overwrite_leaves_the_old_mart(spark, mart, tmp_path):
    path = str(tmp_path / "m")
    store.publish_mart(mart, path)
    before = rows(store.read_mart(spark, path))
    boom = F.udf(lambda x: 1 // 0, "int")
    with pytest.raises(Exception, match="ZeroDivision"):  # some tasks write before one fails
        store.publish_mart(mart.withColumn("distance", F.when(F.col("distance") > 2000, boom("distance")).otherwise(F.col("distance"))), path)
    assert rows(store.read_mart(spark, path)) == before
    store.publish_mart(mart.limit(5), path)
    assert store.read_mart(spark, path).count() == 5
    # The previous version stays for its readers, earlier and failed ones go.
    store.publish_mart(mart.limit(6), path)
    assert len([f for f in os.listdir(path) if f.startswith("v-") and "." not in f]) == 2
    assert not glob.glob(f"{path}/_new-*")


def test_late_weather_rebuilds_its_days_only(spark, inputs, mart, tmp_path):
    path = str(tmp_path / "m")
    flights, weather, airports, zones = inputs
    late = F.col("Date_Time").startswith("2024-01-10")
    first = rollups.publish_with_rollups(etl.build_mart(flights, weather.where(~late), airports, zones, CFG), path)
    old_files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{first}/**/*.parquet", recursive=True)}
    days = rebuild.days_of_weather(flights, weather.where(late), airports, zones, CFG)
    assert days and set(days) <= {"2024-01-09", "2024-01-10", "2024-01-11", None}
    second = rebuild.rebuild_days(path, days, flights, weather, airports, zones, CFG, also=lambda f: rollups.write_rollups(spark, f))
    assert {f: os.stat(f).st_mtime_ns for f in old_files} == old_files
    written = {r[0] for r in spark.read.parquet(second).select(F.col("dep_day").cast("string")).distinct().collect()}
    assert written <= set(days)
    assert rows(store.read_mart(spark, path).drop("dep_day")) == rows(mart)
    # Counts from rollups see the replaced days as the rows do.
    got = rollups.airport_delay_count(spark, path, "arrival", LO, HI)
    assert rows(got) == rows(queries.airport_delay_count(mart, "arrival", LO, HI))
    assert rebuild.rebuild_days(path, [], *inputs, CFG) is None


def test_new_flights_touch_their_own_days(spark, inputs, mart, tmp_path):
    path = str(tmp_path / "m")
    flights, weather, airports, zones = inputs
    new = F.col("FlightDate") == "2024-01-20"
    store.publish_mart(etl.build_mart(flights.where(~new), weather, airports, zones, CFG), path)
    days = rebuild.days_of_flights(flights.where(new), airports, zones, CFG)
    rebuild.rebuild_days(path, days, *inputs, CFG)
    assert rows(store.read_mart(spark, path).drop("dep_day")) == rows(mart)


@pytest.mark.parametrize("column", ["arr_time", "dep_time"])
def test_zone_map_names_the_files_with_matching_rows(spark, mart, tmp_path, column):
    path = str(tmp_path / "m")
    folder = store.publish_mart(mart, path)
    lo, hi = queries.bound("2024-01-08 00:00"), queries.bound("2024-01-15 00:00")
    got = store.read_range(spark, path, column, lo, hi)
    stored = spark.read.schema(store.STORED).parquet(folder)
    want = stored.where((F.col(column) >= lo) & (F.col(column) < hi))
    assert rows(got) == rows(want) and got.count() > 0
    holding = names(r[0] for r in want.select("_metadata.file_path").distinct().collect())
    assert names(got.inputFiles()) == holding and len(holding) < len(stored.inputFiles()) / 2
    assert store.read_range(spark, path, column, hi, lo).count() == 0


def test_factored_mart_grows_with_its_inputs(spark, tmp_path):
    stored, inputs = {}, {}
    for sf in (SF_SMALL, SF_CHECK):
        raw = raw_inputs(spark, sf)
        path = str(tmp_path / sf.rsplit("/", 1)[1])
        factored.write_factored(*raw, CFG, path)
        flights, weather = factored.read_factors(spark, path)
        stored[sf] = flights.count() + weather.count()
        inputs[sf] = etl.clean_flights(raw[0], CFG).count() + raw[1].count()
        assert flights.count() == etl.clean_flights(raw[0], CFG).count()
    assert all(stored[sf] <= inputs[sf] for sf in stored)
    weights = factored.read_weighted(spark, path, ["crosswind_lim"])
    assert weights.agg(F.sum("n_obs")).first()[0] == factored.read_pairs(spark, path).count()


@pytest.mark.parametrize("direction", ["departure", "arrival"])
def test_rollups_equal_the_mart_and_read_edge_days_only(spark, mart, tmp_path, direction):
    path = str(tmp_path / "m")
    rollups.publish_with_rollups(mart, path)
    day = dt.timedelta(days=1)
    midnight = dt.datetime(2024, 1, 8)
    for lo, hi in ((LO, HI), (midnight, midnight + 3 * day), (LO, LO + dt.timedelta(hours=3)), (LO, midnight + day), (HI, LO)):
        for q in ("wind_rose", "airport_delay_count", "crosswind_interruptions"):
            assert rows(getattr(rollups, q)(spark, path, direction, lo, hi)) == rows(getattr(queries, q)(mart, direction, lo, hi)), (q, lo, hi)
    column = "dep_time" if direction == "departure" else "arr_time"
    read = rollups.edges(spark, path, column, LO, HI)
    # Each file read holds rows of an edge day.
    for edge, on in zip(read, (LO, HI)):
        stored = store.read_mart(spark, path).where(F.to_date(column) == F.lit(on.date()))
        assert names(edge.inputFiles()) <= names(r[0] for r in stored.select("_metadata.file_path").distinct().collect())
    assert not rollups.edges(spark, path, column, midnight, midnight + day)


def test_the_mart_is_listed_once_for_zone_map_and_rollups(spark, mart, tmp_path, monkeypatch):
    """Its day folders grow with the mart: neither the zone map nor each rollup may list them again."""
    reader, read, cached = type(spark.read), [], spark._jsparkSession.sharedState().cacheManager().numCachedEntries()
    parquet = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *paths, **kw: (read.extend(paths), parquet(self, *paths, **kw))[1])
    path = str(tmp_path / "m")
    folder = rollups.publish_with_rollups(mart, path)
    assert read == [folder]
    read.clear()
    rollups.write_rollups(spark, folder)
    assert read == [folder]
    monkeypatch.undo()
    assert rows(rollups.wind_rose(spark, path, "arrival", LO, HI)) == rows(queries.wind_rose(mart, "arrival", LO, HI))
    assert spark._jsparkSession.sharedState().cacheManager().numCachedEntries() == cached


def test_malformed_rows_are_quarantined(spark, tmp_path):
    one, two = tmp_path / "one.csv", tmp_path / "two.csv"
    one.write_text("iata_code,timezone\nN01,America/Denver\nN02\nN03,America/Chicago,x\n\"N,04\",UTC\n")
    two.write_text("extra,timezone,iata_code\n1,UTC,N05\n1,UTC\n,,\n")
    good, bad = files.read_checked(spark, [str(one), str(two)], schemas.TIMEZONE_RAW)
    assert sorted(map(str, map(tuple, good.collect()))) == sorted(map(str, [
        ("N01", "America/Denver"), ("N,04", "UTC"), ("N05", "UTC"), (None, None)]))
    assert sorted((r["file"].rsplit("/", 1)[1], r["record"]) for r in bad.collect()) == [
        ("one.csv", "N02"), ("one.csv", "N03,America/Chicago,x"), ("two.csv", "1,UTC")]
    side = str(tmp_path / "side")
    assert files.quarantine(spark, str(one), schemas.TIMEZONE_RAW, side).count() == 2
    assert spark.read.parquet(side).count() == 2
    with pytest.raises(ValueError, match="missing"):
        files.read_checked(spark, str(one), schemas.AIRPORT_RAW)


def test_stable_key_is_dense_and_the_same_for_any_partitioning(spark):
    data = [(None, "b"), (2, None), (1, "a"), (1, "a"), (1, "B"), (3, "é"), (None, None)] * 3
    df = spark.createDataFrame(data, "k int, `odd name` string")
    want = sorted(data, key=lambda r: tuple((x is not None, x if x is not None else 0) if not isinstance(x, str) else (True, x) for x in r))
    for n in (1, 5):
        got = sorted(map(tuple, stable_key(df.repartition(n)).collect()), key=lambda r: r[2])
        assert [r[2] for r in got] == list(range(len(data))) and [r[:2] for r in got] == want
    assert stable_key(df.limit(0)).count() == 0


def test_repeated_codes_keep_the_shuffle_join(spark, tmp_path):
    from windshear.operators.joins import airport_zone_dim, fits_together

    def tables(code, name):
        spark.range(50).select(code.alias("iata_code"), F.lit("1").alias("lat"), F.lit("2").alias("long")).write.parquet(f"{tmp_path}/{name}a")
        spark.range(50).select(code.alias("iata_code"), F.lit("UTC").alias("timezone")).write.parquet(f"{tmp_path}/{name}z")
        return spark.read.parquet(f"{tmp_path}/{name}a"), spark.read.parquet(f"{tmp_path}/{name}z")

    limit = 64 << 10
    once, zones = tables(F.col("id").cast("string"), "once")
    assert dimension_fits(once, zones, airport_zone_dim(once, zones), limit)
    many, much = tables(F.lit("N01"), "many")
    # 50 rows each, but 2,500 joined: the inputs' sizes pass, the count does not.
    assert fits_together(many, much, limit_bytes=limit)
    assert not dimension_fits(many, much, airport_zone_dim(many, much), limit)


def test_many_short_rows_in_a_small_file_are_not_broadcast(spark, tmp_path):
    """Repeated values compress well: the file is far smaller than the rows, whose values are counted."""
    from windshear.operators.joins import broadcast_if_counted, broadcast_if_small

    limit = 256 << 10

    def weather(n):
        at = F.timestamp_seconds(F.col("id") * 300).cast("timestamp_ntz")
        spark.range(0, n, 1, 1).select(at.alias("time_interval"), F.lit("N").alias("card_dir"), F.lit("00-05").alias("binned_wind"),
                                       F.lit(1).cast("long").alias("n")).write.parquet(f"{tmp_path}/{n}/v-1/weather")
        spark.range(0, 10, 1, 1).select(at.alias("time_interval")).write.parquet(f"{tmp_path}/{n}/v-1/flights")
        with open(f"{tmp_path}/{n}/{versions.POINTER}", "w") as f:
            f.write('{"layers": [{"folder": "v-1", "without": []}]}')
        return spark.read.parquet(f"{tmp_path}/{n}/v-1/weather")

    def hinted(df):
        return "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()

    few, many = weather(100), weather(20_000)
    assert hinted(broadcast_if_small(many, limit)) and not hinted(broadcast_if_counted(many, limit))
    assert hinted(broadcast_if_counted(few, limit))
    for n in (100, 20_000):
        got = factored.read_weighted(spark, f"{tmp_path}/{n}", ["card_dir", "binned_wind"], limit)
        assert hinted(got) == (n == 100)
        assert got.agg(F.count("*"), F.sum("n_obs"), F.count("card_dir")).first() == (10, 10, 10)


def test_a_column_called_like_the_weight_is_no_weight(spark):
    df = spark.createDataFrame([("N", "00-05", 7), ("N", "00-05", 7)], "card_dir string, binned_wind string, n_obs long")
    assert aggregates.wind_rose_counts(df).first()["count"] == 2
    assert aggregates.wind_rose_counts(df, "n_obs").first()["count"] == 14
    assert aggregates.interruption_counts(df, {"a": F.lit(True)}).first()["a"] == 2


def test_results_come_in_their_order(spark, mart):
    """O1 and O2 as a client reads them: most delays first, code as tie-break; compass order, then the bin."""
    mart = mart.repartition(7)
    counts = queries.airport_delay_count(mart, "departure", "2024-01-01", "2024-02-01").collect()
    assert [(-r["dep_del15"], r["dep_iata"]) for r in counts] == sorted((-r["dep_del15"], r["dep_iata"]) for r in counts)
    assert len({r["dep_del15"] for r in counts}) < len(counts)  # ties occur
    rose = queries.wind_rose(mart, "departure", "2024-01-01", "2024-02-01").collect()
    assert [(r["index_dir"], r["binned_wind"]) for r in rose] == sorted((r["index_dir"], r["binned_wind"]) for r in rose)


def test_object_store_settings_reach_the_hadoop_configuration(spark):
    """As session settings they become options of the file system that readers use."""
    conf = files.object_store_conf("key", "secret")
    assert set(conf) == {"spark.hadoop.fs.s3a.access.key", "spark.hadoop.fs.s3a.secret.key"}
    spark_conf = spark._jvm.org.apache.spark.SparkConf(False)
    for name, value in conf.items():
        spark_conf.set(name, value)
    hadoop = spark._jvm.org.apache.spark.deploy.SparkHadoopUtil().newConfiguration(spark_conf)
    assert (hadoop.get("fs.s3a.access.key"), hadoop.get("fs.s3a.secret.key")) == ("key", "secret")


def test_versions_of_a_plain_folder(spark, tmp_path):
    assert versions.layers(spark, str(tmp_path)) is None
    assert HubConfig().hub


def test_the_mart_grows_with_its_tables():
    """Ten times the tables (twelve times the hub's flights) make about ten times the mart: periods grow,
    the rows that share a grid key do not."""
    import sql_oracle
    from compare import duck_connection

    n = {}
    for sf in (SF_CHECK, SF_CHECK.replace("0.01", "0.1")):
        con = duck_connection(sf)
        n[sf] = con.execute(sql_oracle._with("SELECT count(*), count(DISTINCT dep_time::DATE) FROM mart")).fetchone()
    (small, days), (large, more) = n.values()
    assert 8 * small < large < 14 * small and more > 9 * days


@pytest.mark.parametrize("name", ["times_in_hub_zone", "weather_hub_time"])
def test_times_on_dst_changes_equal_the_oracle(spark, name):
    """At sf0.1 the periods hold both DST changes of 2024; every time is compared with the oracle's."""
    import __spark_entry__ as entry
    from compare import compare, duck_connection

    sf = SF_CHECK.replace("0.01", "0.1")
    df, sql = entry.queries()[name](spark, sf), entry.oracle_sql()[name]
    column = "dep_time" if name == "times_in_hub_zone" else "observed_utc"
    days = {str(r[0]) for r in df.select(F.to_date(column)).distinct().collect()}
    assert {"2024-03-10", "2024-11-03"} <= days
    ok, msg = compare(df, duck_connection(sf), sql)
    assert ok, msg
