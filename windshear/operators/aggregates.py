"""A1-A3: counts. Each takes the name of a weight column where a row stands for several
(see ``joins.attach_weighted_weather``), so the same question runs over the
stored mart or over the weighted plan. Without it every row counts once, whatever its columns are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(weight: str | None = None) -> Column:
    """Number of mart rows represented (``count(*)`` or the weight sum)."""
    if weight is None:
        return F.count(F.lit(1))
    return F.coalesce(F.sum(F.col(weight)), F.lit(0).cast("long"))


def count_where(cond: Column, weight: str | None = None) -> Column:
    """``count_if`` with weights; 0 (not NULL) over no rows."""
    if weight is None:
        return F.count_if(cond)
    return F.coalesce(F.sum(F.when(cond, F.col(weight))), F.lit(0).cast("long"))


def delays_per_airport(df: DataFrame, iata: str, long: str, lat: str, out: str, weight: str | None = None) -> DataFrame:
    """A1: delayed rows per airport, keyed by code and location."""
    return df.groupBy(iata, long, lat).agg(row_count(weight).alias(out))


def wind_rose_counts(df: DataFrame, weight: str | None = None) -> DataFrame:
    """A3: rows per (direction, speed bin); NULL keys are not counted."""
    kept = df.where(F.col("card_dir").isNotNull() & F.col("binned_wind").isNotNull())
    return kept.groupBy("card_dir", "binned_wind").agg(row_count(weight).alias("count"))


def interruption_counts(df: DataFrame, conditions: dict[str, Column], weight: str | None = None) -> DataFrame:
    """A2: several filtered counts in one pass (one partial/final aggregate)."""
    return df.agg(*[count_where(c, weight).alias(name) for name, c in conditions.items()])
