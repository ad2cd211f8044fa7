"""CSV readers (S1-S4) and result sinks."""

import json

import pytest
from conftest import SF_SMALL

from windshear.plans import etl
from windshear.sources import files, sinks


def test_airport_csv_bom_quotes_blanks(spark, tmp_path):
    p = tmp_path / "airports.csv"
    p.write_bytes(
        "﻿iata,airport,city,state,country,lat,long,cnt\n"
        'ABC,"Alpha, Intl",Town,ST,USA,33.64,-84.43,100\n'
        "DEF,Delta,,,USA,,,\n".encode("utf-8"))
    rows = {r["iata"]: r for r in files.read_airports(spark, str(p)).collect()}
    assert set(rows) == {"ABC", "DEF"}
    assert rows["ABC"]["airport"] == "Alpha, Intl" and rows["ABC"]["lat"] == "33.64"
    assert rows["DEF"]["lat"] is None and rows["DEF"]["city"] is None


def test_flight_csv_by_header_name(spark, tmp_path):
    p = tmp_path / "flights.csv"
    cols = ["Year", "FlightDate", "Reporting_Airline", "Origin", "DepTime", "DepDelay", "DepDel15", "Dest",
            "ArrTime", "ArrDelay", "ArrDel15", "Distance", "CancellationCode", "WeatherDelay",
            "LateAircraftDelay", "Div1Airport"]
    p.write_text(",".join(cols) + "\n"
                 "2019,2019-11-03,DL,ATL,930,-5.00,0.00,BOS,1204,12.00,0.00,946.00,,0.00,0.00,\n")
    from windshear.operators.projections import flight_columns
    r = flight_columns(files.read_flights(spark, str(p))).first()
    assert r["dep_iata"] == "ATL" and r["dep_time"] == "930" and r["dep_delay"] == -5
    assert r["distance"] == 946 and r["cncl_code"] is None


def test_weather_descriptor_rows_dropped(spark, tmp_path):
    p = tmp_path / "weather.csv"
    p.write_text("Date_Time,wind_cardinal_direction_set_1d,wind_direction_set_1,wind_speed_set_1,"
                 "wind_gust_set_1,weather_condition_set_1d\n"
                 ",,,m/s,m/s,\n"
                 "2019-11-03T05:30:00Z,NNW,340.0,7.72,,Light Rain\n")
    from windshear.operators.projections import weather_columns
    rows = weather_columns(files.read_weather(spark, str(p))).collect()
    assert len(rows) == 1 and rows[0]["wind_dir"] == 340 and rows[0]["wind_speed"] == 7.72


ZONE_FILES = {"one.csv": "iata_code,timezone\nABC,America/Denver\n", "two.csv": "timezone,iata_code\nAmerica/Chicago,DEF\n"}


def test_files_with_swapped_columns(spark, tmp_path):
    for name, text in ZONE_FILES.items():
        (tmp_path / name).write_text(text)
    with pytest.raises(Exception, match="(?i)header"):
        files.read_timezones(spark, str(tmp_path)).collect()
    rows = files.read_timezones(spark, [str(tmp_path / n) for n in ZONE_FILES]).collect()
    assert {tuple(r) for r in rows} == {("ABC", "America/Denver"), ("DEF", "America/Chicago")}


def test_file_without_a_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text("iata_code\nABC\n")
    with pytest.raises(ValueError, match="missing columns"):
        files.read_timezones(spark, str(tmp_path / "a.csv"))


def test_columns_json_is_bounded(spark):
    with pytest.raises(ValueError):
        sinks.columns_json(spark.range(30), most=20)


def test_batch_job(spark, tmp_path):
    from windshear import job
    from windshear.sources import fixtures as fx

    raw = dict(zip("fwaz", fx.raw_inputs(spark, SF_SMALL)))
    for name, df in raw.items():
        df.write.option("header", True).csv(str(tmp_path / name))
    mart = job.run(spark, [str(tmp_path / "f")], [str(tmp_path / "w")], str(tmp_path / "a"), str(tmp_path / "z"),
                   fx.FIXTURE_CONFIG, str(tmp_path / "out"))
    assert mart.count() == etl.build_mart(*raw.values(), fx.FIXTURE_CONFIG).count() > 0


def test_airport_files_of_real_size_are_broadcast(spark, tmp_path):
    """221 airports and 9,000 zones: two broadcast joins, and no exchange of the flights."""
    from windshear.sources import fixtures as fx

    code = lambda i: "".join(chr(65 + i // 26 ** k % 26) for k in (2, 1, 0))
    (tmp_path / "a.csv").write_text("iata,airport,city,state,country,lat,long,cnt\n" + "".join(
        f"{code(i)},A{i},C,S,USA,1,2,3\n" for i in range(221)))
    (tmp_path / "z.csv").write_text("iata_code,timezone\n" + "".join(f"{code(i)},America/Denver\n" for i in range(9000)))
    flights = etl.clean_flights(fx.flight_raw(spark, SF_SMALL), fx.FIXTURE_CONFIG)
    out = etl.localise_flights(flights, files.read_airports(spark, str(tmp_path / "a.csv")),
                               files.read_timezones(spark, str(tmp_path / "z.csv")), fx.FIXTURE_CONFIG)
    plan = out._jdf.queryExecution().executedPlan().toString()
    before = flights._jdf.queryExecution().executedPlan().toString()
    count = lambda text, word: sum(word in line for line in text.splitlines())
    assert "hashpartitioning(dep_iata" not in plan and "hashpartitioning(arr_iata" not in plan
    assert count(plan, "BroadcastHashJoin") >= count(before, "BroadcastHashJoin") + 2


def test_arrival_range_prunes_day_folders(spark, tmp_path):
    from windshear.plans import queries
    from windshear.sources import fixtures as fx
    from windshear.sources.mart import read_mart, write_mart

    write_mart(etl.build_mart(*fx.raw_inputs(spark, SF_SMALL), fx.FIXTURE_CONFIG), str(tmp_path / "m"))
    mart = read_mart(spark, str(tmp_path / "m"))
    for direction in ("departure", "arrival"):
        plan = queries.airport_delay_count(mart, direction, "2024-01-08 00:00", "2024-01-15 00:00")
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text


def test_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([("weather delay by CW", 3, 4)], "cond string, dry long, precip long")
    assert json.loads(sinks.as_json_lines(df).first()["json"]) == {"cond": "weather delay by CW", "dry": 3,
                                                                   "precip": 4}
    out = str(tmp_path / "out")
    sinks.write_json(df, out)
    assert spark.read.json(out).count() == 1
    assert sinks.columns_json(df) == {"cond": {"0": "weather delay by CW"}, "dry": {"0": 3}, "precip": {"0": 4}}
    assert sinks.preview(spark.range(100), 20).count() == 20
