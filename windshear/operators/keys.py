"""C14: a key that is the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from windshear.session import scratch_path


def stable_key(df: DataFrame, name: str = "unique_id") -> DataFrame:
    """``df`` with dense ids from 0 in the order of all its columns (NULLs first).

    Equal rows are counted first, so a large group of them moves as one row. The distinct rows are dealt by range and
    written; the ids of a range begin after the rows of those before it, and go on inside it by running sums. Ranges
    may be cut differently on another run or after a lost task; the order, and so the ids, can't.
    """
    import uuid

    spark, cols = df.sparkSession, df.columns
    order = [F.col(f"`{c}`").asc_nulls_first() for c in cols]
    ranged = (df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_m"))
              .repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    path = scratch_path(spark, f"keys/{uuid.uuid4().hex}")
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    # One row for each range.
    sizes = rows.groupBy("_range").agg(F.sum("_m").alias("_s"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_start") + F.coalesce(F.sum("_m").over(inside), F.lit(0))
    return (rows.join(F.broadcast(starts), "_range").withColumn("_first", first)
            .withColumn(name, F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_m") - 1)))
            .select(*[F.col(f"`{c}`") for c in cols], name))
