"""Unit vectors for the scalar operators (edge cases D1-D22)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from windshear.functions import (
    combine_date_clock,
    compass_index,
    crosswind_flag,
    crosswind_limit,
    direction_label,
    gust_override,
    hhmm_minutes,
    hhmm_to_clock,
    precip_flag,
    round_to_grid,
    to_int,
    utc_to_zone,
    wind_bin,
    zone_to_zone,
)
from windshear.functions.times import day_bounds


def _col(spark, values, dtype, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def T(s):
    return dt.datetime.fromisoformat(s)


def test_c1_clock_text(spark):
    raw = [None, "2400", "5", "45", "0005", "130", "930", "1260", "2500", "-5", "abc", "0930", " 930", "12345"]
    want = ["00:00", "00:00", "00:05", "00:45", "00:05", "01:30", "09:30", "00:00", "00:00", "00:00", "00:00",
            "09:30", "00:00", "00:00"]
    assert _col(spark, raw, "string", hhmm_to_clock) == want


def test_c1_midnight_option(spark):
    got = _col(spark, ["2400", "0"], "string", lambda c: hhmm_minutes(c, midnight_is_next_day=True))
    assert got == [1440, 0]


def test_c2_date_and_clock(spark):
    df = spark.createDataFrame([(dt.date(2019, 11, 3), "01:30"), (None, "01:30")], "d date, c string")
    got = [r[0] for r in df.select(combine_date_clock("d", "c")).collect()]
    assert got == [T("2019-11-03 01:30"), None]


def test_c3_pytz_rules(spark):
    vals = [T("2019-11-03 01:30"), T("2019-03-10 02:30"), T("2019-06-01 01:30")]
    df = spark.createDataFrame([(v, "America/Chicago") for v in vals] + [(vals[2], None)],
                               "t timestamp_ntz, z string")
    got = [r[0] for r in df.select(zone_to_zone("t", "z", "America/New_York")).collect()]
    assert got == [T("2019-11-03 02:30"), T("2019-03-10 04:30"), T("2019-06-01 02:30"), None]


def test_c3_independent_of_session_zone(spark, la_zone):
    df = spark.createDataFrame([(T("2019-11-03 01:30"), "America/Chicago")], "t timestamp_ntz, z string")
    assert df.select(zone_to_zone("t", "z", "America/New_York")).first()[0] == T("2019-11-03 02:30")


def test_c4_fall_back_shares_local_hour(spark):
    got = _col(spark, [T("2019-11-03 05:30"), T("2019-11-03 06:30")], "timestamp_ntz",
               lambda c: utc_to_zone(c, "America/New_York"))
    assert got == [T("2019-11-03 01:30"), T("2019-11-03 01:30")]


def test_d21_iso_text_is_wall_clock(spark, la_zone):
    from windshear.functions.casts import to_timestamp_ntz
    got = _col(spark, ["2019-11-03T05:30:00Z"], "string", to_timestamp_ntz)
    assert got == [T("2019-11-03 05:30")]


def test_c5_round_five_minutes(spark):
    vals = [T("2019-01-01 23:57:30.900000"), T("2019-01-01 02:02:29.999000"), T("2019-01-01 00:02:30"), None]
    got = _col(spark, vals, "timestamp_ntz", round_to_grid)
    assert got == [T("2019-01-02 00:00"), T("2019-01-01 02:00"), T("2019-01-01 00:05"), None]


def test_c5_same_in_other_session_zone(spark, la_zone):
    got = _col(spark, [T("2019-03-10 02:02:31")], "timestamp_ntz", round_to_grid)
    assert got == [T("2019-03-10 02:05")]


def test_c9_gust(spark):
    df = spark.createDataFrame([(3.0, 5.0), (5.0, 3.0), (5.0, None), (None, 5.0)], "s double, g double")
    assert [r[0] for r in df.select(gust_override("s", "g")).collect()] == [5.0, 5.0, 5.0, None]


def test_c10_bins_as_double(spark):
    got = _col(spark, [-1.0, 0.0, 2.57, 7.72, 18.01, None, 15.43, 7.719], "double", wind_bin)
    assert got == [None, "00-05", "05-10", "15-20", ">35", None, "30-35", "10-15"]


def test_c11_precip(spark):
    assert _col(spark, ["Fog", "Haze", None], "string", precip_flag) == [0, 1, 1]


def test_c12_crosswind(spark):
    assert _col(spark, ["N", "E", "SW", "VRB", None], "string", crosswind_flag) == [1, 0, 1, 0, 0]


def test_c13_limit(spark):
    df = spark.createDataFrame([(0, 1, 15.43), (1, 1, 7.72), (1, 0, 20.0), (0, 1, 8.0)],
                               "p int, c int, s double")
    assert [r[0] for r in df.select(crosswind_limit("p", "c", "s")).collect()] == [1, 2, 0, 0]


def test_c6_direction(spark):
    df = spark.createDataFrame([("ATL", "BOS"), ("BOS", "ATL"), ("ATL", "ATL"), ("X", "Y")], "d string, a string")
    got = [r[0] for r in df.select(direction_label("d", "a", "ATL")).collect()]
    assert got == ["departure", "arrival", "departure", None]


def test_c18_compass_index(spark):
    assert _col(spark, ["N", "NNW", "VRB", "E"], "string", compass_index) == [0, 15, 0, 4]


def test_d7_tolerant_int(spark):
    got = _col(spark, ["-5.50", "5.00", "12", "HNL", None, "1e12"], "string", to_int)
    assert got == [-5, 5, 12, None, None, None]


def test_d5_weather_code_numeric(spark):
    from windshear.functions.wind import weather_delayed
    assert _col(spark, ["0.00", "17.00", None, "x"], "string", weather_delayed) == [False, True, None, None]


def test_f10_day_bounds(spark):
    lo, hi = day_bounds("2024-01-01", "2024-01-31")
    lo2, hi2 = day_bounds("2024-01-01", "2024-01-31", inclusive_end=True)
    r = spark.range(1).select(lo, hi, hi2).first()
    assert r[0] == T("2024-01-01 00:00") and r[1] == T("2024-01-31 23:59") and r[2] == T("2024-02-01 00:00")


def test_d18_unknown_direction():
    from windshear.operators.projections import role_columns
    with pytest.raises(ValueError):
        role_columns("sideways")
