"""The streaming ETL gives the same mart as the batch ETL, and a restart adds
only new files."""

import shutil

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from windshear.plans import etl
from windshear.sources import fixtures as fx
from windshear.sources.mart import read_mart
from windshear.streaming import flight_stream, start_mart_stream


def test_stream_matches_batch(spark, tmp_path):
    cfg = fx.FIXTURE_CONFIG
    flights, weather, airports, zones = fx.raw_inputs(spark, SF_SMALL)
    landing = str(tmp_path / "landing")
    # Two drops of flight files, split by flight date.
    first = flights.where(F.col("FlightDate") < "2024-01-15")
    second = flights.where(F.col("FlightDate") >= "2024-01-15")
    first.write.option("header", True).csv(landing + "/drop=1")
    mart_path = str(tmp_path / "mart")

    q = start_mart_stream(flight_stream(spark, landing + "/*"), weather, airports, zones, cfg, mart_path)
    q.awaitTermination()
    n1 = read_mart(spark, mart_path).count()

    second.write.option("header", True).csv(landing + "/drop=2")
    q = start_mart_stream(flight_stream(spark, landing + "/*"), weather, airports, zones, cfg, mart_path)
    q.awaitTermination()

    stored = read_mart(spark, mart_path).drop("dep_day")
    batch = etl.build_mart(flights, weather, airports, zones, cfg)
    assert 0 < n1 < stored.count()
    assert stored.count() == batch.count()
    assert stored.exceptAll(batch).count() == 0 and batch.exceptAll(stored).count() == 0

    # Two marts keep separate checkpoints; a mart whose checkpoint is gone is refused rather than overwritten.
    other = str(tmp_path / "other")
    start_mart_stream(flight_stream(spark, landing + "/*"), weather, airports, zones, cfg, other).awaitTermination()
    assert read_mart(spark, other).count() == batch.count()
    shutil.rmtree(other + "/_checkpoint")
    with pytest.raises(RuntimeError, match="checkpoint"):
        start_mart_stream(flight_stream(spark, landing + "/*"), weather, airports, zones, cfg, other)
