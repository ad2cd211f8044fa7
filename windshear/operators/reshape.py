"""Compass zero-fill, the interruption matrix, wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windshear.config import CANCEL_ROW_LABEL, COMPASS, DELAY_ROW_LABEL, ZERO_FILL_BIN
from windshear.functions.labels import compass_index


def compass_frame(spark: SparkSession, compass: Sequence[str] = COMPASS) -> DataFrame:
    """The 16-point compass as a dimension: ``card_dir``, ``index_dir``.

    Built from literals on the JVM side (no Python rows, no Python worker).
    """
    points = F.posexplode(F.array(*[F.lit(d) for d in compass])).alias("index_dir", "card_dir")
    return spark.range(1).select(points).select("card_dir", F.col("index_dir").cast("int").alias("index_dir"))


def zero_fill_compass(counts: DataFrame, compass: Sequence[str] = COMPASS) -> DataFrame:
    """R1 + U2 (+ C18): index every direction and add ``(dir, '00-05', 0)`` for
    each compass point with no count, so all 16 appear.

    The counts are read once: the 16 filler rows are unioned in and a filler
    survives only where its direction has no real row. The window partitions
    hold at most one row per speed bin plus the filler.
    """
    real = counts.select("card_dir", "binned_wind", "count",
                         compass_index("card_dir", compass).alias("index_dir"), F.lit(False).alias("_fill"))
    fills = compass_frame(counts.sparkSession, compass).select(
        "card_dir", F.lit(ZERO_FILL_BIN).alias("binned_wind"), F.lit(0).cast("long").alias("count"),
        "index_dir", F.lit(True).alias("_fill"))
    has_real = F.max(F.when(~F.col("_fill"), F.lit(1)).otherwise(F.lit(0))).over(Window.partitionBy("card_dir"))
    # The aggregate is finished in parallel; its result, bounded by directions x
    # speed bins, then moves to one partition, where the window needs no shuffle.
    both = real.unionByName(fills).repartition(1).withColumn("_has_real", has_real)
    return both.where(~F.col("_fill") | (F.col("_has_real") == 0)).drop("_fill", "_has_real")


def interruption_matrix(counts: DataFrame) -> DataFrame:
    """R2 + U1: one row of four counts to the 2 x 3 table ``cond, dry, precip``."""
    return counts.select(
        F.stack(
            F.lit(2),
            F.lit(DELAY_ROW_LABEL), F.col("dry_delay"), F.col("wet_delay"),
            F.lit(CANCEL_ROW_LABEL), F.col("dry_cncl"), F.col("wet_cncl"),
        ).alias("cond", "dry", "precip")
    )


def bars_long(matrix: DataFrame) -> DataFrame:
    """The matrix in long form, one row per (cause, runway condition)."""
    return matrix.unpivot(["cond"], ["dry", "precip"], "runway", "n")
