"""Scalar operators: each returns a ``Column`` built from native Spark expressions."""

from windshear.functions.casts import to_date, to_double, to_float, to_int, to_timestamp_ntz
from windshear.functions.labels import (
    compass_index,
    delay_side,
    direction_label,
    hub_side_time,
    interruption_class,
    surrogate_key,
)
from windshear.functions.times import (
    combine_date_clock,
    day_bounds,
    hhmm_minutes,
    hhmm_to_clock,
    minutes_to_clock,
    round_to_grid,
    timestamp_literal,
    utc_to_zone,
    zone_to_zone,
)
from windshear.functions.wind import (
    crosswind_flag,
    crosswind_limit,
    gust_override,
    precip_flag,
    weather_delayed,
    wind_bin,
)

__all__ = [
    "to_date", "to_double", "to_float", "to_int", "to_timestamp_ntz",
    "compass_index", "delay_side", "direction_label", "hub_side_time", "interruption_class",
    "surrogate_key",
    "combine_date_clock", "day_bounds", "hhmm_minutes", "hhmm_to_clock", "minutes_to_clock",
    "round_to_grid", "timestamp_literal", "utc_to_zone", "zone_to_zone",
    "crosswind_flag", "crosswind_limit", "gust_override", "precip_flag", "weather_delayed",
    "wind_bin",
]
