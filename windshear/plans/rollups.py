"""A1-A3 from day rollups: partial counts by day that add up.

For each direction the three counts of Q1-Q3 are kept by day and key, in a table beside each version
folder of the mart. A question over ``[lo, hi)`` adds up the whole days inside the range, and counts only
the rows of the two edge days in the mart, read through its zone map.
Rollups of disjoint rows merge by addition, as the edge counts do. They also hold the stored day of
their rows, so that days which a rebuild replaced drop out of an older layer's rollups as out of its rows.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windshear.functions.times import timestamp_literal
from windshear.functions.wind import weather_delayed
from windshear.operators.filters import delayed_15, runway_condition, weather_cancelled
from windshear.operators.projections import role_columns
from windshear.operators.reshape import interruption_matrix
from windshear.plans.queries import finish_delay_count, finish_wind_rose
from windshear.sources.mart import DAY_COLUMN, publish_mart, read_layers, read_mart, read_range

DAY = "day"
DIRECTIONS = ("departure", "arrival")
COUNTS = {"wind_rose": ["count"], "delays": ["n"], "interruptions": ["dry_delay", "wet_delay", "dry_cncl", "wet_cncl"]}


def keys(question: str, direction: str) -> list[str]:
    c = role_columns(direction)
    return {"wind_rose": ["card_dir", "binned_wind"], "delays": [c.iata, c.long, c.lat], "interruptions": []}[question]


def partial_counts(rows: DataFrame, question: str, direction: str) -> DataFrame:
    """The counts of a question by stored day, day and key over rows of a stored mart."""
    c = role_columns(direction)
    rows = rows.where(F.col(c.time).isNotNull()).withColumn(DAY, F.to_date(c.time))
    by = [DAY_COLUMN, DAY, *keys(question, direction)]
    if question == "interruptions":
        delayed, cancelled = weather_delayed("wthr_code"), weather_cancelled()
        return rows.where(F.col("crosswind_lim").isin(1, 2) & (delayed | cancelled)).groupBy(by).agg(*[
            F.count_if(runway_condition(k) & what).alias(name) for name, k, what in (
                ("dry_delay", 1, delayed), ("wet_delay", 2, delayed), ("dry_cncl", 1, cancelled), ("wet_cncl", 2, cancelled))])
    rows = rows.where(delayed_15(c.del15))
    if question == "wind_rose":
        rows = rows.where(F.col("card_dir").isNotNull() & F.col("binned_wind").isNotNull())
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias(COUNTS[question][0]))


def merge(parts: list[DataFrame], by: list[str], counts: list[str]) -> DataFrame:
    """Partial counts of disjoint rows added up by some of their keys."""
    total = [F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in counts]
    rows = reduce(DataFrame.unionByName, [p.select(*by, *counts) for p in parts])
    return rows.groupBy(by).agg(*total) if by else rows.agg(*total)


def rollup_path(folder: str, question: str, direction: str) -> str:
    return f"{folder.rstrip('/')}.rollups/{direction}/{question}"


def read_columns() -> list[str]:
    """The columns of a stored mart that the rollups read."""
    roles = [role_columns(direction) for direction in DIRECTIONS]
    own = [name for c in roles for name in (c.iata, c.long, c.lat, c.time, c.del15)]
    return [*own, "card_dir", "binned_wind", "crosswind_lim", "wthr_code", "cncl_code", DAY_COLUMN]


def write_rollups(spark: SparkSession, folder: str, stored: DataFrame | None = None) -> None:
    """The six rollups of a mart folder, sorted by day; ``stored``: its rows, where they were read before.

    The days of a mart grow with it, and each has its folder: these are listed and read once for all six.
    The columns read stay in memory, on disk where they do not fit, until the rollups are written.
    """
    rows = (read_mart(spark, folder) if stored is None else stored).select(*read_columns()).persist()
    try:
        for direction in DIRECTIONS:
            for question in COUNTS:
                part = partial_counts(rows, question, direction)
                part.sortWithinPartitions(DAY).write.mode("overwrite").parquet(rollup_path(folder, question, direction))
    finally:
        rows.unpersist()


def publish_with_rollups(mart: DataFrame, path: str, *, replaces: list[str | None] | None = None) -> str:
    """Publish a mart, or some days of it, with zone map and rollups in one swap."""
    return publish_mart(mart, path, replaces=replaces, from_rows=lambda folder, rows: write_rollups(mart.sparkSession, folder, rows))


def whole_days(lo: dt.datetime, hi: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """The first day that begins at ``lo`` or later, and the day in which ``hi`` lies (its midnight)."""
    midnight = dt.datetime.combine(lo.date(), dt.time())
    return midnight + dt.timedelta(days=midnight < lo), dt.datetime.combine(hi.date(), dt.time())


def edges(spark: SparkSession, path: str, time_col: str, lo: dt.datetime, hi: dt.datetime) -> list[DataFrame]:
    """The mart rows of the partial days of ``[lo, hi)``; of a range without a whole day all rows."""
    first, last = whole_days(lo, hi)
    cuts = [(lo, hi)] if first >= last else [(lo, first), (last, hi)]
    return [read_range(spark, path, time_col, timestamp_literal(a), timestamp_literal(b)) for a, b in cuts if a < b]


def counts(spark: SparkSession, path: str, question: str, direction: str, lo: dt.datetime, hi: dt.datetime) -> DataFrame:
    """The counts of a question over ``[lo, hi)`` by its keys."""
    first, last = whole_days(lo, hi)
    by, names = keys(question, direction), COUNTS[question]
    parts = [partial_counts(e, question, direction) for e in edges(spark, path, role_columns(direction).time, lo, hi)]
    stored = read_layers(spark, path, lambda folder: spark.read.parquet(rollup_path(folder, question, direction)))
    parts.append(stored.where((F.col(DAY) >= F.lit(first.date())) & (F.col(DAY) < F.lit(last.date()))))
    return merge(parts, by, names)


def wind_rose(spark: SparkSession, path: str, direction: str, lo: dt.datetime, hi: dt.datetime) -> DataFrame:
    """Q1 over a mart with rollups."""
    return finish_wind_rose(counts(spark, path, "wind_rose", direction, lo, hi))


def airport_delay_count(spark: SparkSession, path: str, direction: str, lo: dt.datetime, hi: dt.datetime) -> DataFrame:
    """Q2 over a mart with rollups."""
    c = role_columns(direction)
    found = counts(spark, path, "delays", direction, lo, hi).withColumnRenamed("n", c.del15)
    return finish_delay_count(found, direction)


def crosswind_interruptions(spark: SparkSession, path: str, direction: str, lo: dt.datetime, hi: dt.datetime) -> DataFrame:
    """Q3 over a mart with rollups."""
    return interruption_matrix(counts(spark, path, "interruptions", direction, lo, hi))
