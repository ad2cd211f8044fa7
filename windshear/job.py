"""The batch job: four CSV inputs to the stored mart.

    spark-submit -m windshear.job --flights s3a://in/flights --weather s3a://in/weather.csv \\
        --airports s3a://in/airports.csv --zones s3a://in/zones.csv \\
        --hub ATL --hub-tz America/New_York --out s3a://out/mart
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from windshear.config import HubConfig
from windshear.plans import etl
from windshear.sources import files
from windshear.sources.mart import publish_mart, read_mart
from windshear.sources.sinks import schema_text


def run(spark: SparkSession, flights: list[str], weather: list[str], airports: str, zones: str, cfg: HubConfig, out: str):
    """E1-E4 over the given paths; returns the stored mart. A run that fails leaves the mart published before."""
    mart = etl.build_mart(files.read_flights(spark, flights), files.read_weather(spark, weather),
                          files.read_airports(spark, airports), files.read_timezones(spark, zones), cfg)
    publish_mart(mart, out)
    return read_mart(spark, out)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--flights", nargs="+", required=True, help="files or folders; each is read by its own header")
    p.add_argument("--weather", nargs="+", required=True)
    for name in ("airports", "zones", "hub", "hub-tz", "out"):
        p.add_argument(f"--{name}", required=True)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("windshear-batch").getOrCreate()
    mart = run(spark, a.flights, a.weather, a.airports, a.zones, HubConfig(hub=a.hub, hub_tz=a.hub_tz), a.out)
    print(schema_text(mart))


if __name__ == "__main__":
    main()
