"""Row filters as predicates or DataFrame steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windshear.config import WEATHER_CANCELLATION_CODE
from windshear.functions.wind import weather_delayed  # noqa: F401  (F7, re-exported)


# Days by which the two times of a flight can differ, at most.
ARRIVAL_DAYS = 4


def hub_filter(df: DataFrame, hub: str) -> DataFrame:
    """flights that depart from or arrive at the hub."""
    return df.where((F.col("dep_iata") == hub) | (F.col("arr_iata") == hub))


def time_window(time_col: str, lo: Column, hi: Column) -> Column:
    """``lo <= t < hi`` (NULL times fail it)."""
    return (F.col(time_col) >= lo) & (F.col(time_col) < hi)


def window_with_pruning(df: DataFrame, time_col: str, lo: Column, hi: Column) -> Column:
    """F3 plus, on a mart stored by departure day, the implied day predicate;
    stating it lets the scan skip whole day directories.

    ``lo <= dep_time < hi`` implies ``to_date(lo) <= dep_day <= to_date(hi)``.
    Both times of a flight come from one flight date: a clock adds at most a
    day (two with the overnight roll) and a zone moves it by at most a day, so
    they lie within ``ARRIVAL_DAYS`` of each other. An arrival range implies
    that margin around its days, or no departure day at all (D9).
    """
    pred = time_window(time_col, lo, hi)
    if "dep_day" not in df.columns:
        return pred
    day = F.col("dep_day")
    if time_col == "dep_time":
        return pred & (day >= F.to_date(lo)) & (day <= F.to_date(hi))
    near = (day >= F.date_sub(F.to_date(lo), ARRIVAL_DAYS)) & (day <= F.date_add(F.to_date(hi), ARRIVAL_DAYS))
    return pred & (day.isNull() | near)


def delayed_15(del15_col: str) -> Column:
    """delayed by 15 minutes or more."""
    return F.col(del15_col) > 0


def not_null(*cols: str) -> Column:
    """all the given columns are present."""
    pred = F.lit(True)
    for c in cols:
        pred = pred & F.col(c).isNotNull()
    return pred


def runway_condition(k: int) -> Column:
    """crosswind over the dry (1) or wet (2) limit."""
    return F.col("crosswind_lim") == k


def weather_cancelled() -> Column:
    """F8: cancelled for weather."""
    return F.col("cncl_code") == WEATHER_CANCELLATION_CODE


def exclude_airport(df: DataFrame, iata_col: str, code: str) -> DataFrame:
    """drop one airport (the hub) from a per-airport result."""
    return df.where(F.col(iata_col) != code)
