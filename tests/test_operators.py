"""Operator-level tests: reshaping, weighting, de-duplication, layout."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from windshear.config import HubConfig
from windshear.operators.joins import attach_weighted_weather, broadcast_if_small, estimated_size_bytes
from windshear.operators.reshape import bars_long, interruption_matrix, zero_fill_compass
from windshear.plans import etl, queries


def test_r1_zero_fill(spark):
    counts = spark.createDataFrame([("N", "05-10", 3)], "card_dir string, binned_wind string, count long")
    out = zero_fill_compass(counts).collect()
    assert len(out) == 16
    zeros = [r for r in out if r["count"] == 0]
    assert len(zeros) == 15 and all(r["binned_wind"] == "00-05" for r in zeros)
    assert sorted(r["index_dir"] for r in out) == list(range(16))


def test_r2_r3_matrix(spark):
    c = spark.createDataFrame([(1, 2, 3, 4)], "dry_delay long, wet_delay long, dry_cncl long, wet_cncl long")
    m = interruption_matrix(c).collect()
    assert [tuple(r) for r in m] == [("weather delay by CW", 1, 2), ("weather cancellation by CW", 3, 4)]
    assert bars_long(interruption_matrix(c)).count() == 4


def test_weighted_join_counts_like_fanout(spark):
    flights = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0), "a"), (dt.datetime(2024, 1, 1, 0, 5), "b"), (None, "c")],
        "time_interval timestamp_ntz, f string")
    weather = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0), "N"), (dt.datetime(2024, 1, 1, 0, 0), "N"),
         (dt.datetime(2024, 1, 1, 0, 0), "S")], "time_interval timestamp_ntz, card_dir string")
    fan = flights.join(weather, "time_interval", "left")
    w = attach_weighted_weather(flights, weather, ["card_dir"], 1 << 20)
    assert w.agg(F.sum("n_obs")).first()[0] == fan.count() == 5
    by_dir = {r[0]: r[1] for r in w.groupBy("card_dir").agg(F.sum("n_obs")).collect()}
    assert by_dir == {"N": 2, "S": 1, None: 2}


def test_broadcast_only_when_estimated_small(spark):
    df = spark.range(10)
    assert estimated_size_bytes(df) is not None
    assert "broadcast" in str(broadcast_if_small(df, 1 << 20)._jdf.queryExecution().analyzed()).lower()
    assert "broadcast" not in str(broadcast_if_small(df, 1)._jdf.queryExecution().analyzed()).lower()


def test_dedupe_latest_picks_later_utc(spark):
    cfg = HubConfig(hub="N08")
    raw = spark.createDataFrame(
        [("2019-11-03T05:30:00Z", "N", "0", "1.0", None, "Clear"),
         ("2019-11-03T06:30:00Z", "S", "0", "2.0", None, "Clear")],
        "Date_Time string, wind_cardinal_direction_set_1d string, wind_direction_set_1 string, "
        "wind_speed_set_1 string, wind_gust_set_1 string, weather_condition_set_1d string")
    w = etl.dedupe_latest(etl.clean_weather(raw, cfg, keep_utc=True)).collect()
    assert len(w) == 1 and w[0]["card_dir"] == "S" and w[0]["time_interval"] == dt.datetime(2019, 11, 3, 1, 30)


def test_mart_layout_roundtrip(spark, tmp_path):
    from conftest import SF_SMALL
    from windshear.sources.fixtures import FIXTURE_CONFIG, raw_inputs
    from windshear.sources.mart import read_mart, write_mart

    mart = etl.build_mart(*raw_inputs(spark, SF_SMALL), FIXTURE_CONFIG)
    path = str(tmp_path / "mart")
    write_mart(mart, path)
    stored = read_mart(spark, path)
    assert stored.count() == mart.count()
    q = queries.airport_delay_count(stored, "departure", "2024-01-05 00:00", "2024-01-10 00:00")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "dep_day" in plan
    lazy = queries.airport_delay_count(mart, "departure", "2024-01-05 00:00", "2024-01-10 00:00")
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, lazy.collect()))
    arr = queries.crosswind_interruptions(stored, "arrival", "2024-01-05 00:00", "2024-01-10 00:00")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        arr.explain("formatted")
    pushed = [line for line in buf.getvalue().splitlines() if line.startswith("PushedFilters")]
    assert any("GreaterThanOrEqual(arr_time" in p and "In(crosswind_lim" in p for p in pushed)


def _flight_raw(spark, rows):
    cols = ["FlightDate", "Reporting_Airline", "Origin", "DepTime", "DepDelay", "DepDel15", "Dest", "ArrTime",
            "ArrDelay", "ArrDel15", "Distance", "CancellationCode", "WeatherDelay", "LateAircraftDelay",
            "Div1Airport"]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_d3_overnight_option(spark):
    raw = _flight_raw(spark, [
        ("2024-01-01", "X", "ATL", "2300", "0", "0", "BOS", "0100", "0", "0", "1", None, None, "0", None),
        ("2024-01-01", "X", "ATL", "2400", "0", "0", "BOS", "0130", "0", "0", "1", None, None, "0", None),
    ])
    same_day = etl.clean_flights(raw, HubConfig()).orderBy("dep_time").collect()
    rolled = etl.clean_flights(raw, HubConfig(roll_overnight=True)).orderBy("dep_time").collect()
    D = dt.datetime
    assert [(r["dep_time"], r["arr_time"]) for r in same_day] == [
        (D(2024, 1, 1, 0, 0), D(2024, 1, 1, 1, 30)), (D(2024, 1, 1, 23, 0), D(2024, 1, 1, 1, 0))]
    assert [(r["dep_time"], r["arr_time"]) for r in rolled] == [
        (D(2024, 1, 1, 23, 0), D(2024, 1, 2, 1, 0)), (D(2024, 1, 2, 0, 0), D(2024, 1, 2, 1, 30))]


def test_d15_snap_weather_option(spark):
    raw = spark.createDataFrame(
        [("2024-01-01T05:02:00Z", "N", "0", "1.0", None, "Clear")],
        "Date_Time string, wind_cardinal_direction_set_1d string, wind_direction_set_1 string, "
        "wind_speed_set_1 string, wind_gust_set_1 string, weather_condition_set_1d string")
    off = etl.clean_weather(raw, HubConfig()).first()["time_interval"]
    on = etl.clean_weather(raw, HubConfig(snap_weather=True)).first()["time_interval"]
    assert off == dt.datetime(2024, 1, 1, 0, 2) and on == dt.datetime(2024, 1, 1, 0, 0)


def test_p9_count_name(spark):
    rows = spark.createDataFrame(
        [("N01", 1.0, 2.0, dt.datetime(2024, 1, 1, 1, 0), 1)],
        "dep_iata string, dep_long float, dep_lat float, dep_time timestamp_ntz, dep_del15 int")
    out = queries.airport_delay_count(rows, "departure", "2024-01-01 00:00", "2024-01-02 00:00",
                                      count_name="delay_count")
    assert out.columns == ["dep_iata", "dep_long", "dep_lat", "delay_count"] and out.first()["delay_count"] == 1
