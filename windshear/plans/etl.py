"""Clean flights and weather, enrich, and project the mart.

Each step is a plain function over DataFrames; the chain stays one lazy plan,
so Catalyst prunes columns and pushes the hub filter into the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windshear.config import HubConfig
from windshear.functions.labels import delay_side, direction_label, hub_side_time
from windshear.functions.times import at_minutes, hhmm_minutes, round_to_grid, utc_to_zone, zone_to_zone
from windshear.functions.wind import crosswind_flag, crosswind_limit, gust_override, precip_flag, wind_bin
from windshear.operators.filters import hub_filter
from windshear.operators.joins import (
    airport_zone_dim,
    attach_airports,
    attach_weather,
    attach_weather_split,
    attach_weighted_weather,
    dimension_fits,
)
from windshear.operators.projections import (
    airport_columns,
    flight_columns,
    flight_side_projection,
    mart_projection,
    timezone_columns,
    weather_columns,
)

def flight_times(df: DataFrame, cfg: HubConfig) -> DataFrame:
    """C1 + C2 on both ends: ``HHMM`` text and flight date to wall-clock timestamps.

    The clock text is turned straight into minutes (no intermediate string);
    ``hhmm_to_clock`` gives the same ``HH:MM`` text when it is wanted.
    """
    dep_m = hhmm_minutes("dep_time", midnight_is_next_day=cfg.roll_overnight)
    arr_m = hhmm_minutes("arr_time", midnight_is_next_day=cfg.roll_overnight)
    if cfg.roll_overnight:
        # D3 option: an arrival clock earlier than the departure clock is on the next day.
        arr_m = F.when(arr_m < dep_m, arr_m + 1440).otherwise(arr_m)
    return df.withColumns({
        "dep_time": at_minutes("date", dep_m),
        "arr_time": at_minutes("date", arr_m),
    })


def clean_flights(raw: DataFrame, cfg: HubConfig) -> DataFrame:
    """P1, F2, C6, C1 x2, C2 x2, C7, C8, C5.

    ``time_interval`` is taken from the hub-side time before any zone change:
    that time is already the hub's local time.
    """
    df = hub_filter(flight_columns(raw), cfg.hub)
    df = df.withColumn("dep_or_arr", direction_label("dep_iata", "arr_iata", cfg.hub))
    df = flight_times(df, cfg)
    df = df.withColumns({"date_time": hub_side_time(), "delay_time": delay_side()})
    return df.withColumn("time_interval", round_to_grid("date_time", cfg.grid_seconds))


def clean_weather(raw: DataFrame, cfg: HubConfig, *, keep_utc: bool = False) -> DataFrame:
    """F1, P2, C9, C10, C11, C4, C12, C13.

    With ``keep_utc`` the observation's UTC time is kept as ``observed_utc``
    (needed to pick the latest observation, D14).
    """
    df = weather_columns(raw)
    if keep_utc:
        df = df.withColumn("observed_utc", F.col("time_interval"))
    df = df.withColumn("wind_speed", gust_override("wind_speed", "gust_speed"))
    df = df.withColumn("binned_wind", wind_bin("wind_speed", cfg.wind_bounds, cfg.wind_labels))
    df = df.withColumn("precip", precip_flag("precip", cfg.dry_conditions))
    local = utc_to_zone("time_interval", cfg.hub_tz)
    if cfg.snap_weather:
        local = round_to_grid(local, cfg.grid_seconds)
    df = df.withColumn("time_interval", local)
    df = df.withColumn("crosswind", crosswind_flag("card_dir", cfg.crosswind_directions))
    return df.withColumn(
        "crosswind_lim",
        crosswind_limit("precip", "crosswind", "wind_speed", cfg.dry_limit, cfg.wet_limit),
    )


def dedupe_latest(weather: DataFrame) -> DataFrame:
    """D14 option: one observation per grid key, the latest in UTC.

    Ties are broken by every other column, so the pick is deterministic. A
    ``max`` over a struct is a partial aggregate: it combines map-side, so a
    key holding a large share of the rows does not land whole in one task
    (as a ``row_number`` window would).
    """
    others = [c for c in weather.columns if c not in ("time_interval", "observed_utc")]
    best = F.max(F.struct("observed_utc", *others)).alias("best")
    return weather.groupBy("time_interval").agg(best).select("time_interval", *[f"best.{c}" for c in others])


def airport_dimension(airports_raw: DataFrame, zones_raw: DataFrame) -> DataFrame:
    """P3 + P4 + J2: code, latitude, longitude and zone of each airport."""
    return airport_zone_dim(airport_columns(airports_raw), timezone_columns(zones_raw))


def localise_flights(flights: DataFrame, airports_raw: DataFrame, zones_raw: DataFrame, cfg: HubConfig) -> DataFrame:
    """J2 + J3 + J4 + C3 x2: airport location and zone, then both times in the hub zone."""
    dim = airport_dimension(airports_raw, zones_raw)
    small = dimension_fits(airport_columns(airports_raw), timezone_columns(zones_raw), dim, cfg.broadcast_limit)
    df = attach_airports(flights, dim, cfg.broadcast_limit, small=small)
    return df.withColumns({
        "dep_time": zone_to_zone("dep_time", "dep_timezone", cfg.hub_tz),
        "arr_time": zone_to_zone("arr_time", "arr_timezone", cfg.hub_tz),
    })


def prepared_weather(weather_raw: DataFrame, cfg: HubConfig) -> DataFrame:
    """E2 plus the configured de-duplication."""
    if cfg.weather_dedupe == "latest":
        return dedupe_latest(clean_weather(weather_raw, cfg, keep_utc=True))
    return clean_weather(weather_raw, cfg)


def enrich(flights_raw: DataFrame, weather_raw: DataFrame, airports_raw: DataFrame,
           zones_raw: DataFrame, cfg: HubConfig, *, keep: Column | None = None) -> DataFrame:
    """J1, J2, P5, J3, J4, C3 x2. ``keep`` cuts the localised flights before they meet weather.

    The dimension joins (broadcast, no shuffle) run before the weather join,
    so they see each flight once rather than once per weather observation.
    """
    flights = localise_flights(clean_flights(flights_raw, cfg), airports_raw, zones_raw, cfg)
    flights = flights if keep is None else flights.where(keep)
    weather = prepared_weather(weather_raw, cfg)
    if cfg.hot_key_rows is not None:
        return attach_weather_split(flights, weather, hot_key_rows=cfg.hot_key_rows,
                                    buckets=cfg.salt_buckets, limit_bytes=cfg.broadcast_limit)
    return attach_weather(flights, weather)


def build_mart(flights_raw: DataFrame, weather_raw: DataFrame, airports_raw: DataFrame,
               zones_raw: DataFrame, cfg: HubConfig, *, with_diverted_iata: bool = False) -> DataFrame:
    """E1-E3 + P6: the 24-column mart as one lazy plan."""
    return mart_projection(enrich(flights_raw, weather_raw, airports_raw, zones_raw, cfg),
                           with_diverted_iata=with_diverted_iata)


def weighted_mart(flights_raw: DataFrame, weather_raw: DataFrame, airports_raw: DataFrame,
                  zones_raw: DataFrame, cfg: HubConfig, attrs: Sequence[str]) -> DataFrame:
    """The mart's flight columns with only the weather ``attrs`` a question needs,
    plus a weight ``n_obs``: the number of mart rows each row stands for.

    Counting ``sum(n_obs)`` over it equals ``count(*)`` over the mart, but the
    flight x observation pairs of a repeated key are never formed.
    """
    flights = localise_flights(clean_flights(flights_raw, cfg), airports_raw, zones_raw, cfg)
    rows = flight_side_projection(flights)
    weather = prepared_weather(weather_raw, cfg).select("time_interval", *attrs)
    return attach_weighted_weather(rows, weather, attrs, cfg.broadcast_limit).drop("time_interval")
