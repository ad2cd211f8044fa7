"""Mixing sources to target token amounts by entropy balancing, in DataFrame
operations only.

1. Targets. Sources, ordered by code point with null last, get the repeating
   weights and share ``share`` times all sizes; none may exceed ``most`` times its
   source's size, and what is cut off is shared again by weight (water-filling: the
   common level comes from running sums over the sources sorted by the level that
   fills them).
2. Rates. Documents start at rate 1. The rates closest to that in relative entropy that
   meet each source's token constraint and stay at or below ``most`` are
   ``min(most, exp(lambda_source * size / mean size))``: exponentially tilted by size. The dual
   is convex in lambda; safeguarded Newton steps solve it for all sources at once,
   each step one aggregate over the histogram (source, size, number of documents).
3. Copies. Rates are rounded by a running sum of rates over the documents of a source in
   the order (size, hash of the id): a document gets as many copies as the sum
   passes whole numbers. The sum is split in offsets of size classes, of slices of a
   class and places in a slice, so no source or class has to meet in one task. A
   source's taken tokens so miss the target by about one document. Rows that agree in id,
   source, size and text are a block with one place: of its rows the sum gives all ``copies``, and ``extra`` of them one more.

Sums that decide copies are taken over rates in whole millionths, so reruns agree.

Defined cases: null, empty and blank texts have size 0 and get one copy in
sources with a positive target but take no words; a source of size 0 has target 0; repeated rows
are a block, see above, and which of them gets the extra copy makes no difference to the mix;
a null id or source is a value of its own; an empty table gives no rows; ``documents``
may have further columns, also ones named like the results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from windshear.llm.common import small_enough, stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
SLICE = 2000
MAX_STEPS = 60
MICRO = 1_000_000
RUN = 10_000
SOURCE_BYTES = 32 << 20


def size_of(text: Column) -> Column:
    """Number of runs of characters other than space and \\t..\\r; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` of ``sizes(source, size)``: one row per source.
    The running sums read one row per source in one task."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("i") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("i", F.row_number().over(by_name)).withColumn("weight", weight)
    per = per.withColumn("cap", most * F.col("source_size"))
    # A source is full once the level (amount per weight) reaches cap / weight.
    by_level = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "i")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.least(share * F.sum("source_size").over(everything), F.sum("cap").over(everything))
    per = (per.withColumn("total", total)
           .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("open", F.sum("weight").over(after)))
    # The level if all sources before this one are full; the true one is the first that this source's cap allows.
    per = per.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("i", "level"))
    first = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("level", F.first(fits, ignorenulls=True).over(first)["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return per.select("source", "source_size", target.alias("target"), F.col("i").alias("sid"))


def tilts(cells: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """``(sid, lam, mean)`` solving sum(n * size * min(most, exp(lam * size / mean))) = target
    for every source, from ``cells(sid, size, n)``."""
    top = math.log(most)
    cells = cells.where("size > 0")
    state = (cells.groupBy("sid").agg(F.sum(F.col("n") * F.col("size")).alias("s"), F.sum("n").alias("m"), F.min("size").alias("z"))
             .join(targets.select("sid", "target"), "sid")
             .select("sid", "target", (F.col("s") / F.col("m")).alias("mean"), F.lit(0.0).alias("lam"),
                     F.lit(-1e6).alias("lo"), (F.lit(top) * F.col("s") / F.col("m") / F.col("z")).alias("hi"),
                     F.lit(False).alias("done")))
    state = stored(state, "tilt")
    for _ in range(MAX_STEPS):
        x = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("lam") * x, F.lit(top)))
        free = (F.col("lam") * x < top).cast("double")
        g = cells.join(state.select("sid", "lam", "mean"), "sid").groupBy("sid").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("total"),
            F.sum(F.col("n") * F.col("size") * rate * x * free).alias("slope"))
        gap = F.col("total") - F.col("target")
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        lo = F.when(gap <= 0, F.col("lam")).otherwise(F.col("lo"))
        step = F.col("lam") - F.when(F.col("slope") > 0, gap / F.col("slope"))
        # Outside the bracket a Newton step gives way to its middle, or to a step down where there is no lower end yet.
        middle = F.when(F.col("lo2") <= -1e6, F.col("lam") - 4).otherwise((F.col("lo2") + F.col("hi2")) / 2)
        inside = (F.col("step") > F.col("lo2")) & (F.col("step") < F.col("hi2")) & (F.col("step") > F.col("lam") - 4)
        near = F.abs(gap) <= 1e-7 * F.greatest(F.col("target"), F.lit(1.0))
        tight = F.col("hi") - F.col("lo") <= 1e-12
        state = (state.join(g, "sid")
                 .withColumn("done2", F.col("done") | near | tight | (F.col("lam") < -700))
                 .withColumn("lo2", lo).withColumn("hi2", hi).withColumn("step", step)
                 .select("sid", "target", "mean",
                         F.when(F.col("done2"), F.col("lam")).when(inside, F.col("step")).otherwise(middle).alias("lam"),
                         F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), F.col("done2").alias("done")))
        state = stored(state, "tilt")
        if state.where("NOT done").isEmpty():
            break
    else:
        raise RuntimeError(f"the rates of a source did not converge in {MAX_STEPS} steps")
    return state.select("sid", "lam", "mean")


def copies(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per block, the ``m`` rows of ``sizes`` that agree in KEY: ``(*KEY, source_size, target, m, copies, extra)``."""
    keys = sizes.groupBy(*KEY).agg(F.count("*").alias("m"))
    targets = stored(source_targets(sizes, weights, share, most), "targets")
    keys = stored(keys.join(targets.select(F.col("source").alias("_s"), "sid"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "keys")
    cells = stored(keys.groupBy("sid", "size").agg(F.sum("m").alias("n")), "cells")
    lam = tilts(cells, targets, most)
    rate = F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(math.log(most))))
    rate = F.when(F.col("target") <= 0, F.lit(0.0)).otherwise(F.coalesce(rate, F.lit(1.0)))
    rated = (cells.join(targets.select("sid", "target", "source_size"), "sid").join(lam, "sid", "left")
             .withColumn("rate", F.round(rate * MICRO).cast("long"))
             .select("sid", "size", "n", "rate", "target", "source_size"))
    classes = Window.partitionBy("sid").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rated = stored(rated.withColumn("offset", F.coalesce(F.sum(F.col("n") * F.col("rate")).over(classes), F.lit(0)).cast("long"))
                   .withColumn("slices", F.ceil(F.col("n") / SLICE).cast("long")), "rated")
    order = F.xxhash64("doc_id", "tkey")
    placed = (keys.join(rated.drop("n"), ["sid", "size"])
              .withColumn("h", order).withColumn("slice", F.pmod(F.xxhash64("h"), F.col("slices"))))
    counts = placed.groupBy("sid", "size", "slice").agg(F.sum("m").alias("k"))
    slices = Window.partitionBy("sid", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("sid", "size", "slice", F.coalesce(F.sum("k").over(slices), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("sid", "size", "slice").orderBy("h", "doc_id", "tkey").rowsBetween(Window.unboundedPreceding, -1)
    placed = (placed.join(counts, ["sid", "size", "slice"])
              .withColumn("rank", F.col("earlier") + F.coalesce(F.sum("m").over(within), F.lit(0))))
    start = F.col("offset") + F.col("rank") * F.col("rate") + MICRO // 2
    whole = F.floor((start + F.col("m") * F.col("rate")) / MICRO) - F.floor(start / MICRO)
    # No rate exceeds ``most``, so neither does the share of a row.
    return placed.select(*KEY, "source_size", "target", "m", F.floor(whole / F.col("m")).cast("long").alias("copies"),
                         F.pmod(whole, F.col("m")).cast("long").alias("extra"))


KEY = ["doc_id", "source", "size", "tkey"]


def _sizes(docs: DataFrame) -> DataFrame:
    return stored(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), F.xxhash64("text").alias("tkey")), "sizes")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per row of ``docs(doc_id, source, text)``: ``(doc_id, size, source_size, target, taken)``."""
    made = copies(_sizes(docs), weights, share, most)
    # The rows of a block are told apart by their copies alone; large blocks are written out in runs of RUN rows.
    kinds = F.explode(F.array(F.struct((F.col("m") - F.col("extra")).alias("k"), F.col("copies").alias("c")),
                              F.struct(F.col("extra").alias("k"), (F.col("copies") + 1).alias("c"))))
    rows = made.select("doc_id", "size", "source_size", "target", kinds.alias("x")).select("*", "x.k", "x.c").where("k > 0")
    rows = rows.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("k") - 1) / RUN))))
    rows = rows.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(RUN).cast("long"), F.col("k") - F.col("run") * RUN))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("c")).alias("taken"))


def _light(made: DataFrame) -> bool:
    """Whether a table of blocks may be broadcast: counted rows, and counted bytes of their source names."""
    return small_enough(made) and made.agg(F.coalesce(F.sum(F.octet_length("_source")), F.lit(0))).first()[0] <= SOURCE_BYTES


def mixed_rows(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, and ``copy`` from 1 up."""
    made = copies(_sizes(docs), weights, share, most).where("copies > 0 OR extra > 0")
    made = stored(made.select(*[F.col(c).alias("_" + c) for c in [*KEY, "m", "copies", "extra"]]), "copies")
    named = "_" + "_".join(docs.columns)  # longer than any column's name

    def joined(rows: DataFrame, side: DataFrame) -> DataFrame:
        side = side.select(F.struct(*side.columns).alias(named), *[F.col(c) for c in ("_doc_id", "_source", "_size", "_tkey")])
        same = (rows["doc_id"].eqNullSafe(F.col("_doc_id")) & rows["source"].eqNullSafe(F.col("_source"))
                & (F.xxhash64(rows["text"]) == F.col("_tkey")) & (size_of(rows["text"]) == F.col("_size")))
        return rows.join(F.broadcast(side) if _light(side) else side, same).select(*[rows[c] for c in rows.columns], named)

    def written(rows: DataFrame, n: Column) -> DataFrame:
        return rows.where(n > 0).select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("copy"))

    block = F.col(named)
    even = written(joined(docs, made.where("_extra = 0")), block["_copies"])
    odd = made.where("_extra > 0")
    if odd.isEmpty():
        return even
    # The rows of uneven blocks are numbered: by the part of the table that holds them, then inside it.
    parts, row = F.struct(block, F.col(named + "p")), named + "r"
    some = stored(joined(docs, odd).withColumn(named + "p", F.spark_partition_id()), "uneven")
    counts = some.groupBy(block.alias("b"), F.col(named + "p").alias("p")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("b").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.struct("b", "p").alias("key"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(row + "0"))
    inside = Window.partitionBy(parts).orderBy(F.xxhash64("text"))
    some = some.withColumn(row, F.row_number().over(inside))
    some = some.join(counts, (block == F.col("key")["b"]) & (F.col(named + "p") == F.col("key")["p"]))
    return even.union(written(some, block["_copies"] + (F.col(row) + F.col(row + "0") <= block["_extra"]).cast("long")))
