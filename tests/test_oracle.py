"""Every catalogued query against its DuckDB oracle on the sf0.01 tables,
plus invariants from the survey's test strategy."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import compare, duck_connection
from conftest import SF_CHECK, SF_SMALL

# The training-data operators have their own tests.
QUERIES = {k: f for k, f in entry.queries().items() if k in entry.CATALOG}
SQL = {k: q for k, q in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_CHECK)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    ok, msg = compare(QUERIES[name](spark, SF_CHECK), duck, SQL[name])
    assert ok, msg


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["card_dir", "binned_wind", "count", "index_dir"]
    assert df.count() >= 16


def test_invariants(spark):
    from windshear.plans import etl
    from windshear.sources.fixtures import FIXTURE_CONFIG, raw_inputs

    raw = raw_inputs(spark, SF_SMALL)
    flights = etl.clean_flights(raw[0], FIXTURE_CONFIG).count()
    mart = QUERIES["mart"](spark, SF_SMALL)
    assert mart.count() >= flights
    assert QUERIES["mart_dedupe"](spark, SF_SMALL).count() == flights
    rose = QUERIES["wind_rose_departure"](spark, SF_SMALL)
    expected = mart.where(
        (F.col("dep_time") >= F.lit("2024-01-01 00:00").cast("timestamp_ntz"))
        & (F.col("dep_time") < F.lit("2024-02-01 00:00").cast("timestamp_ntz"))
        & (F.col("dep_del15") > 0) & F.col("card_dir").isNotNull() & F.col("binned_wind").isNotNull()).count()
    assert rose.agg(F.sum("count")).first()[0] == expected
    cw = QUERIES["crosswind_departure"](spark, SF_SMALL).collect()
    assert [r["cond"] for r in cw] == ["weather delay by CW", "weather cancellation by CW"]
    assert all(r["dry"] >= 0 and r["precip"] >= 0 for r in cw)


def test_results_independent_of_session_zone(spark, la_zone):
    from windshear.session import local_session  # noqa: F401
    a = sorted(map(tuple, QUERIES["crosswind_arrival"](spark, SF_SMALL).collect()))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    b = sorted(map(tuple, QUERIES["crosswind_arrival"](spark, SF_SMALL).collect()))
    assert a == b


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("stored_", "streamed_"))))
def test_no_python_in_plans(spark, name):
    """Every plan stays on the JVM: no Python UDF, no Arrow/pandas evaluation,
    no RDD of Python rows."""
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "ExistingRDD", "PythonEvals"):
        assert marker not in plan, f"{name}: {marker} in plan"


_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
          "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(n for n in SQL if not n.startswith(("stored_", "streamed_"))))
def test_oracle_column_types(spark, duck, name):
    """Same column names and types on both sides, so value hashes compare like with like."""
    spark_types = {c: _TYPES.get(t, t) for c, t in QUERIES[name](spark, SF_CHECK).dtypes}
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert spark_types == duck_types
