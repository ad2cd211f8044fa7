"""Direction labels, hub-side picks, interruption classes, compass index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from windshear.config import COMPASS, WEATHER_CANCELLATION_CODE
from windshear.functions.casts import _col
from windshear.functions.wind import weather_delayed


def direction_label(dep_iata: Column | str, arr_iata: Column | str, hub: str) -> Column:
    """``departure`` when the flight leaves the hub, ``arrival`` when it lands
    there, else NULL. Both ends at the hub count as departure (D20)."""
    return (
        F.when(_col(dep_iata) == F.lit(hub), F.lit("departure"))
        .when(_col(arr_iata) == F.lit(hub), F.lit("arrival"))
    )


def hub_side_time(label: Column | str = "dep_or_arr", dep: Column | str = "dep_time",
                  arr: Column | str = "arr_time") -> Column:
    """The time at the hub end of the flight."""
    lab = _col(label)
    return F.when(lab == "departure", _col(dep)).when(lab == "arrival", _col(arr))


def delay_side(label: Column | str = "dep_or_arr", dep: Column | str = "dep_delay",
               arr: Column | str = "arr_delay") -> Column:
    """The delay at the hub end of the flight."""
    return hub_side_time(label, dep, arr)


def interruption_class(lim_condition: Column) -> Column:
    """Why a flight under crosswind ``lim_condition`` was interrupted.

    1 weather delay, 2 weather cancellation, 3 departure delayed 15+,
    4 arrival delayed 15+, 5 arrival diverted; NULL otherwise. The diversion
    test uses the airport text (``diverted_iata``), since the integer
    ``diverted`` column of the mart is always NULL (D6).
    """
    dep = F.col("dep_or_arr") == "departure"
    arr = F.col("dep_or_arr") == "arrival"
    return (
        F.when(lim_condition & weather_delayed("wthr_code"), F.lit(1))
        .when(lim_condition & (F.col("cncl_code") == WEATHER_CANCELLATION_CODE), F.lit(2))
        .when(lim_condition & dep & (F.col("dep_del15") > 0), F.lit(3))
        .when(lim_condition & arr & (F.col("arr_del15") > 0), F.lit(4))
        .when(lim_condition & arr & F.col("diverted_iata").isNotNull(), F.lit(5))
    )


def compass_index(card_dir: Column | str, compass: Sequence[str] = COMPASS) -> Column:
    """Position 0-15 of the direction on the compass; unknown (``VRB``) gives 0."""
    pos = F.array_position(F.array(*[F.lit(d) for d in compass]), _col(card_dir)) - 1
    return F.greatest(pos, F.lit(0)).cast("int")


def surrogate_key() -> Column:
    """C14: a unique, increasing (not consecutive) 64-bit id per row."""
    return F.monotonically_increasing_id()
