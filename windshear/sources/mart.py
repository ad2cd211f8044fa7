"""The mart as a Parquet table laid out for date-range questions.

Layout: one directory per departure day (``dep_day``), rows sorted by
``dep_time`` inside each file. A departure-time range prunes day directories
(the questions add the implied ``dep_day`` predicate). For arrival times a zone map
beside the table holds, for each file, the least and greatest of both times and the days on which
they fall: ``read_range`` reads the files that can hold matching rows and no others.

``path`` may be a plain folder (``write_mart``) or one published by
``sources.versions``; readers take both.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windshear.operators.filters import time_window
from windshear.schemas import MART
from windshear.sources import versions

DAY_COLUMN = "dep_day"
# A streamed mart holds one folder per micro-batch above the day folders.
BATCH_COLUMN = "batch_id"
STORED = T.StructType(MART.fields + [T.StructField(DAY_COLUMN, T.DateType())])


def write_mart(mart: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Write the mart partitioned by departure day, sorted by time.

    ``rebalance`` lets AQE size the write tasks and split a day that holds a
    large share of the rows (for instance the NULL day of flights whose
    airport is missing) instead of sending a whole day to one task.
    """
    staged = mart.withColumn(DAY_COLUMN, F.to_date("dep_time"))
    (staged.hint("rebalance", DAY_COLUMN)
     .sortWithinPartitions(DAY_COLUMN, "dep_time", "arr_time")
     .write.mode(mode).partitionBy(DAY_COLUMN).parquet(path))


def publish_mart(mart: DataFrame, path: str, *, replaces: list[str | None] | None = None,
                 also: Callable[[str], None] | None = None, from_rows: Callable[[str, DataFrame], None] | None = None) -> str:
    """Write the mart and its zone map as a new version, then swap it in (``versions.publish``).
    ``also`` writes what else belongs to the version, given its folder; ``from_rows`` as well, given the folder
    and its stored rows: the day folders, which grow with the mart, are listed once for it and the zone map."""
    spark = mart.sparkSession

    def write(folder: str) -> None:
        write_mart(mart, folder)
        rows = spark.read.schema(STORED).parquet(folder)
        write_zone_map(spark, folder, rows)
        if from_rows:
            from_rows(folder, rows)
        if also:
            also(folder)

    return versions.publish(spark, path, write, replaces=replaces)


def _folders(spark: SparkSession, path: str) -> list[versions.Layer]:
    return versions.layers(spark, path) or [versions.Layer(path)]


def _keep(without: list[str | None]) -> Column:
    """The days of a layer that are still its own."""
    days = [F.lit(d).cast("date") for d in without if d is not None]
    keep = ~F.col(DAY_COLUMN).isin(days) if days else F.lit(True)
    return keep & F.col(DAY_COLUMN).isNotNull() if None in without else keep | F.col(DAY_COLUMN).isNull()


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """The stored mart with its day column; filters reach the scan. The batch
    folders of a streamed mart are read as one table, the layers of a published one as well."""
    return read_layers(spark, path, lambda folder: spark.read.schema(STORED).parquet(folder).drop(BATCH_COLUMN))


def read_layers(spark: SparkSession, path: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """What ``read`` gives for each layer of a mart, less the days that later layers replace."""
    parts = []
    for layer in _folders(spark, path):
        part = read(layer.folder)
        parts.append(part.where(_keep(layer.without)) if layer.without else part)
    return reduce(DataFrame.unionByName, parts)


# --- the zone map -----------------------------------------------------------------------

def zone_path(folder: str) -> str:
    return f"{folder.rstrip('/')}.zones"


def write_zone_map(spark: SparkSession, folder: str, stored: DataFrame | None = None) -> None:
    """One row for each file of a mart folder: least and greatest departure and arrival
    time, and the days on which they fall (as many as a file has days, whatever its rows)."""
    stored = spark.read.schema(STORED).parquet(folder) if stored is None else stored
    rows = stored.select("dep_time", "arr_time", F.col("_metadata.file_path").alias("file"))
    ranges = [f(c).alias(f"{c}_{n}") for c in ("dep_time", "arr_time")
              for f, n in ((F.min, "min"), (F.max, "max"), (lambda x: F.collect_set(F.to_date(x)), "days"))]
    rows.groupBy("file").agg(*ranges).write.mode("overwrite").parquet(zone_path(folder))


def files_in_range(spark: SparkSession, folder: str, time_col: str, lo: Column, hi: Column) -> list[str]:
    """The files of a mart folder that can hold rows with ``lo <= time_col < hi``."""
    day_has = F.exists(f"{time_col}_days", lambda d: (d >= F.to_date(lo)) & (d.cast("timestamp_ntz") < hi))
    hit = (F.col(f"{time_col}_min") < hi) & (F.col(f"{time_col}_max") >= lo) & day_has
    return [r["file"] for r in spark.read.parquet(zone_path(folder)).where(hit).select("file").collect()]


def read_range(spark: SparkSession, path: str, time_col: str, lo: Column, hi: Column) -> DataFrame:
    """The rows with ``lo <= time_col < hi``, from the files that the zone map names."""
    parts = []
    for layer in _folders(spark, path):
        found = files_in_range(spark, layer.folder, time_col, lo, hi)
        if found:
            part = spark.read.schema(STORED).option("basePath", layer.folder).parquet(*found)
            parts.append(part.where(_keep(layer.without)) if layer.without else part)
    if not parts:
        return spark.createDataFrame([], STORED)
    return reduce(DataFrame.unionByName, parts).where(time_window(time_col, lo, hi))
