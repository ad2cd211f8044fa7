"""Rebuilding only the days that new input touches.

New flights touch their own departure days. A late weather file touches the days of the
flights whose grid key it holds. Only these days are built again, from all
inputs, and laid over the published mart in one swap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windshear.config import HubConfig
from windshear.operators.projections import mart_projection
from windshear.plans import etl
from windshear.sources.mart import publish_mart


def _days(flights: DataFrame) -> list[str | None]:
    """The departure days of some flights; bounded by the days of the period."""
    return sorted((r[0] for r in flights.select(F.to_date("dep_time").cast("string")).distinct().collect()),
                  key=lambda d: (d is None, d))


def days_of_flights(new_flights_raw: DataFrame, airports_raw: DataFrame, zones_raw: DataFrame, cfg: HubConfig) -> list[str | None]:
    """The days that new flights belong to."""
    return _days(etl.localise_flights(etl.clean_flights(new_flights_raw, cfg), airports_raw, zones_raw, cfg))


def days_of_weather(flights_raw: DataFrame, late_weather_raw: DataFrame, airports_raw: DataFrame, zones_raw: DataFrame,
                    cfg: HubConfig) -> list[str | None]:
    """The days of the flights that late observations meet."""
    flights = etl.localise_flights(etl.clean_flights(flights_raw, cfg), airports_raw, zones_raw, cfg)
    late = etl.clean_weather(late_weather_raw, cfg).select("time_interval").distinct()
    return _days(flights.join(late, "time_interval", "left_semi"))


def rebuild_days(path: str, days: list[str | None], flights_raw: DataFrame, weather_raw: DataFrame,
                 airports_raw: DataFrame, zones_raw: DataFrame, cfg: HubConfig, *,
                 also: Callable[[str], None] | None = None) -> str | None:
    """Build ``days`` of the mart from all inputs and publish them over the others; None if there are none.

    The flights are cut to these days before the weather join.
    """
    if not days:
        return None
    day = F.to_date("dep_time")
    wanted = day.isin([F.lit(d).cast("date") for d in days if d is not None] or [F.lit(None).cast("date")])
    wanted = F.coalesce(wanted, F.lit(False)) | (day.isNull() if None in days else F.lit(False))
    rows = etl.enrich(flights_raw, weather_raw, airports_raw, zones_raw, cfg, keep=wanted)
    return publish_mart(mart_projection(rows), path, replaces=days, also=also)
