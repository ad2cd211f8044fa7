"""Q1-Q6: the questions asked of the mart.

Each takes rows with mart columns: the stored mart (``sources.mart``), the lazy
mart plan, or the weighted plan of ``etl.weighted_mart`` (then ``weight`` names
its weight column). Bounds are typed literals (D22); ``[lo, hi)`` is half-open (D17).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windshear.config import COMPASS
from windshear.functions.times import day_bounds, timestamp_literal
from windshear.functions.wind import weather_delayed
from windshear.operators.aggregates import delays_per_airport, interruption_counts, wind_rose_counts
from windshear.operators.filters import (
    delayed_15,
    exclude_airport,
    not_null,
    runway_condition,
    weather_cancelled,
    window_with_pruning,
)
from windshear.operators.projections import other_role, role_columns
from windshear.operators.reshape import bars_long, interruption_matrix, zero_fill_compass

Bound = str | _dt.datetime | _dt.date | Column


def bound(b: Bound) -> Column:
    """A typed bound literal (or the column as given)."""
    return b if isinstance(b, Column) else timestamp_literal(b)


def wind_rose(rows: DataFrame, direction: str, lo: Bound, hi: Bound,
              compass: Sequence[str] = COMPASS, weight: str | None = None) -> DataFrame:
    """Q1: delayed rows per wind direction and speed bin, all 16 directions present.

    Output ``card_dir, binned_wind, count, index_dir`` ordered by compass
    position then bin.
    """
    c = role_columns(direction)
    kept = rows.where(
        window_with_pruning(rows, c.time, bound(lo), bound(hi))
        & delayed_15(c.del15) & not_null(c.time, "card_dir")
    )
    return finish_wind_rose(wind_rose_counts(kept, weight), compass)


def finish_wind_rose(counts: DataFrame, compass: Sequence[str] = COMPASS) -> DataFrame:
    """R1 + O2 on the (direction, bin) counts.

    The zero-filled result is one small partition (see ``zero_fill_compass``),
    so it is ordered in place rather than through a range shuffle.
    """
    return zero_fill_compass(counts, compass).sortWithinPartitions("index_dir", "binned_wind")


def airport_delay_count(rows: DataFrame, direction: str, lo: Bound, hi: Bound,
                        *, counterpart: bool = False, count_name: str | None = None, weight: str | None = None) -> DataFrame:
    """Q2: delayed rows per airport, most delays first.

    Default (the original code's meaning, D16): all rows in range, grouped by
    the ``direction`` end. ``counterpart=True`` gives the README's meaning:
    flights leaving (or reaching) the hub, grouped by their other end.
    Output: code, longitude, latitude and the count, named after ``del15``
    (P8) or ``count_name`` (P9, e.g. ``delay_count``).
    """
    c = role_columns(direction)
    pred = window_with_pruning(rows, c.time, bound(lo), bound(hi)) & not_null(c.time) & delayed_15(c.del15)
    key = c
    if counterpart:
        pred = pred & (F.col("dep_or_arr") == direction)
        key = other_role(direction)
    kept = rows.where(pred)
    out = finish_delay_count(delays_per_airport(kept, key.iata, key.long, key.lat, c.del15, weight), direction,
                             counterpart=counterpart)
    return out.withColumnRenamed(c.del15, count_name) if count_name else out


def delay_count_keys(direction: str, *, counterpart: bool = False):
    """(count role, key role) of Q2: the end whose time and delay are read, and
    the end the delays are grouped by."""
    c = role_columns(direction)
    return c, (other_role(direction) if counterpart else c)


def finish_delay_count(counts: DataFrame, direction: str, *, counterpart: bool = False) -> DataFrame:
    """O1: most delays first, airport code as tie-break.

    The counts are finished in parallel; then one row per airport (bounded by
    the three-letter code space) is ordered in a single partition, without a
    sampling job.
    """
    c, key = delay_count_keys(direction, counterpart=counterpart)
    return counts.repartition(1).sortWithinPartitions(F.col(c.del15).desc(), F.col(key.iata))


def crosswind_interruptions(rows: DataFrame, direction: str, lo: Bound, hi: Bound, *, weight: str | None = None) -> DataFrame:
    """Q3: weather delays and weather cancellations under crosswind, dry vs wet.

    Output two rows ``cond, dry, precip``: delays first, then cancellations.
    The four counts are taken in one aggregate.
    """
    c = role_columns(direction)
    kept = rows.where(
        window_with_pruning(rows, c.time, bound(lo), bound(hi))
        & F.col("crosswind_lim").isin(1, 2)
        & (weather_delayed("wthr_code") | weather_cancelled())
    )
    counts = interruption_counts(kept, {
        "dry_delay": runway_condition(1) & weather_delayed("wthr_code"),
        "wet_delay": runway_condition(2) & weather_delayed("wthr_code"),
        "dry_cncl": runway_condition(1) & weather_cancelled(),
        "wet_cncl": runway_condition(2) & weather_cancelled(),
    }, weight)
    return interruption_matrix(counts)


def delay_map(rows: DataFrame, hub: str, direction: str, start, end, *,
              inclusive_end: bool = False) -> DataFrame:
    """Q4: Q2 over a day range, the hub itself removed."""
    lo, hi = day_bounds(start, end, inclusive_end=inclusive_end)
    counts = airport_delay_count(rows, direction, lo, hi)
    return exclude_airport(counts, role_columns(direction).iata, hub)


def interruption_bars(rows: DataFrame, direction: str, start, end, *,
                      inclusive_end: bool = False) -> DataFrame:
    """Q5: Q3 over a day range, in long form ``cond, runway, n``."""
    lo, hi = day_bounds(start, end, inclusive_end=inclusive_end)
    return bars_long(crosswind_interruptions(rows, direction, lo, hi))


def wind_rose_days(rows: DataFrame, direction: str, start, end, *,
                   inclusive_end: bool = False) -> DataFrame:
    """Q6: Q1 over a day range."""
    lo, hi = day_bounds(start, end, inclusive_end=inclusive_end)
    return wind_rose(rows, direction, lo, hi)


# Weather attributes each question reads; the weighted plan keeps only these.
QUESTION_ATTRS = {
    "wind_rose": ("card_dir", "binned_wind"),
    "airport_delay_count": (),
    "crosswind_interruptions": ("crosswind_lim",),
}
