"""Wind speed, bins, precipitation and crosswind flags.

Speeds are compared as doubles (D4): comparing float32 speeds with double
bounds would move 5 of the 7 positive bounds to the other side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from windshear.config import (
    CROSSWIND_DIRECTIONS,
    DRY_CONDITIONS,
    DRY_LIMIT,
    WET_LIMIT,
    WIND_BOUNDS,
    WIND_LABELS,
)
from windshear.functions.casts import _col


def gust_override(speed: Column | str, gust: Column | str) -> Column:
    """The gust replaces the speed when it is at least the speed.

    D12: a NULL speed stays NULL even with a gust (not ``greatest``).
    """
    s, g = _col(speed), _col(gust)
    return F.when(g >= s, g).otherwise(s)


def wind_bin(
    speed: Column | str,
    bounds: Sequence[float] = WIND_BOUNDS,
    labels: Sequence[str] = WIND_LABELS,
) -> Column:
    """Label of the half-open bin ``[bounds[i], bounds[i+1])`` holding the speed.

    The last bin is open above; a NULL or negative speed gets NULL (D13).
    """
    s = _col(speed).cast("double")
    expr = None
    for i, (lo, label) in enumerate(zip(bounds, labels)):
        cond = s >= F.lit(float(lo))
        if i + 1 < len(bounds):
            cond = cond & (s < F.lit(float(bounds[i + 1])))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def has_wind_bin(speed: Column | str, bounds: Sequence[float] = WIND_BOUNDS) -> Column:
    """True exactly where ``wind_bin`` is not NULL: the speed is at least the lowest bound.

    Cheaper to filter on than ``wind_bin(...).isNotNull()``: a pushed-down
    filter inlines the expression it tests, and this one reads the speed once.
    """
    return _col(speed).cast("double") >= F.lit(float(bounds[0]))


def precip_flag(condition: Column | str, dry: Sequence[str] = DRY_CONDITIONS) -> Column:
    """C11: 0 for a dry-runway condition, 1 for anything else, missing included."""
    return F.when(_col(condition).isin(list(dry)), F.lit(0)).otherwise(F.lit(1))


def crosswind_flag(card_dir: Column | str, directions: Sequence[str] = CROSSWIND_DIRECTIONS) -> Column:
    """1 when the cardinal direction blows across the runways, else 0."""
    return F.when(_col(card_dir).isin(list(directions)), F.lit(1)).otherwise(F.lit(0))


def crosswind_limit(
    precip: Column | str,
    crosswind: Column | str,
    speed: Column | str,
    dry_limit: float = DRY_LIMIT,
    wet_limit: float = WET_LIMIT,
) -> Column:
    """1 = dry runway over the dry limit, 2 = wet runway over the wet limit, else 0."""
    p, c, s = _col(precip), _col(crosswind), _col(speed).cast("double")
    return (
        F.when((p == 0) & (c == 1) & (s >= F.lit(float(dry_limit))), F.lit(1))
        .when((p == 1) & (c == 1) & (s >= F.lit(float(wet_limit))), F.lit(2))
        .otherwise(F.lit(0))
    )


def weather_delayed(wthr_code: Column | str) -> Column:
    """a positive weather delay. D5: numeric, so ``'0.00'`` does not count."""
    return _col(wthr_code).try_cast("double") > 0
