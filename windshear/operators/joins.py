"""J1-J4 and the join helpers.

Broadcasts are only hinted for a side whose planned size has been checked
against a limit; beyond it the join is left to the shuffle strategies (and to
AQE, which may still switch to a broadcast from runtime sizes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windshear.operators.projections import airport_role

WEIGHT = "n_obs"


def estimated_size_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan, or None when unavailable."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # e.g. Spark Connect, where the JVM plan is not reachable
        return None


def broadcast_if_small(df: DataFrame, limit_bytes: int) -> DataFrame:
    """Hint a broadcast only when the side is known to be under ``limit_bytes``."""
    size = estimated_size_bytes(df)
    if size is not None and size <= limit_bytes:
        return F.broadcast(df)
    return df


def spread(df: DataFrame, *keys: str, min_partitions: int | None = None) -> DataFrame:
    """Give a fact input at least as many partitions as the cluster has cores.

    A large input is read in many splits and is left alone; one that has
    fewer splits than there are cores (a single row group, or an unsplittable
    file) would otherwise run every downstream broadcast join in one task. The
    check plans the scan and counts its splits, no job runs.

    With ``keys`` (a well-spread column such as a row id) the rows are hashed
    on them: deterministic, so a lost partition recomputes identically, and
    no sort is needed. Without keys a round-robin repartition is used, which
    Spark makes deterministic by sorting each input partition first.
    """
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    try:
        splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    except AttributeError:  # e.g. Spark Connect, where the JVM plan is not reachable
        return df
    if not 0 < splits < want:
        return df
    return df.repartition(want, *keys) if keys else df.repartition(want)


def airport_zone_dim(airports: DataFrame, zones: DataFrame) -> DataFrame:
    """Airports left-joined with their time zone."""
    return airports.join(zones, on="iata_code", how="left")


def fits_together(*sides: DataFrame, limit_bytes: int) -> bool:
    """Whether the planned sizes of all sides add up to at most ``limit_bytes``."""
    sizes = [estimated_size_bytes(s) for s in sides]
    return all(s is not None for s in sizes) and sum(sizes) <= limit_bytes


def counted_bytes(df: DataFrame) -> int:
    """The size of a table's values, counted by a job: the text of each, and 16 bytes for each field."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    total = sum(texts[1:], texts[0]) + 16 * len(texts)
    return df.agg(F.coalesce(F.sum(total.cast("long")), F.lit(0))).first()[0]


def broadcast_if_counted(df: DataFrame, limit_bytes: int) -> DataFrame:
    """Hint a broadcast only when the planned size and the values themselves, counted by a job, are under ``limit_bytes``.

    The planned size stems from compressed files: the hash table of many short rows takes many times that in every
    task's executor. What is too large by its planned size is not counted.
    """
    size = estimated_size_bytes(df)
    if size is not None and size <= limit_bytes and counted_bytes(df) <= limit_bytes:
        return F.broadcast(df)
    return df


def dimension_fits(airports: DataFrame, zones: DataFrame, dim: DataFrame, limit_bytes: int) -> bool:
    """Whether the joined dimension is at most ``limit_bytes``, counted.

    The planned sizes of its two tables rule out large ones without a job. They bound the join
    only where no code repeats, so what passes is counted: a code with a rows in one table and z in the
    other stands with a * z. The products are summed from both tables' counts before the join itself is sized.
    """
    if not fits_together(airports, zones, limit_bytes=limit_bytes):
        return False
    a = airports.groupBy("iata_code").agg(F.count(F.lit(1)).alias("_a"))
    z = zones.groupBy("iata_code").agg(F.count(F.lit(1)).alias("_z"))
    n = a.join(z, "iata_code", "left").agg(F.sum(F.col("_a") * F.coalesce("_z", F.lit(1)))).first()[0] or 0
    return n * 16 * len(dim.columns) <= limit_bytes and counted_bytes(dim) <= limit_bytes


def attach_airports(flights: DataFrame, dim: DataFrame, limit_bytes: int, *, small: bool | None = None) -> DataFrame:
    """J3 + J4: the airport dimension as departure and as arrival airport (left joins).

    The dimension holds one row per airport code. Catalyst estimates a join as
    the product of its sides, so a caller who built the dimension from two
    tables passes ``small``, found from the sizes of these tables
    (``fits_together``); without it the dimension's own estimate is checked.
    """
    dep, arr = airport_role(dim, "dep"), airport_role(dim, "arr")
    if small is None:
        dep, arr = broadcast_if_small(dep, limit_bytes), broadcast_if_small(arr, limit_bytes)
    elif small:
        dep, arr = F.broadcast(dep), F.broadcast(arr)
    return flights.join(dep, on="dep_iata", how="left").join(arr, on="arr_iata", how="left")


def attach_weather(flights: DataFrame, weather: DataFrame, limit_bytes: int | None = None) -> DataFrame:
    """Flights left-joined with weather on the 5-minute key.

    Repeated weather keys fan a flight out (D14), as in the original job.
    """
    w = broadcast_if_small(weather, limit_bytes) if limit_bytes else weather
    return flights.join(w, on="time_interval", how="left")


def attach_weather_split(flights: DataFrame, weather: DataFrame, *, hot_key_rows: int,
                         buckets: int = 16, chunk_rows: int = 10_000,
                         limit_bytes: int = 64 << 20) -> DataFrame:
    """J1 with hot keys split over ``buckets`` tasks; same rows as ``attach_weather``.

    The weather is reduced to distinct rows with a multiplicity (a partial
    aggregate). A key with more than ``hot_key_rows`` observations is hot; the
    hot-key set has at most rows / ``hot_key_rows`` entries and is broadcast
    only under ``limit_bytes``. At a hot key, multiplicities are cut into
    chunks of ``chunk_rows``, each chunk is hashed to a bucket, and each flight is copied
    once per bucket, so that it meets each chunk in exactly one bucket; other
    keys have the one bucket 0. One left join on (key, bucket) follows, and
    each chunk is expanded back to its rows. So neither many distinct
    observations nor many identical copies of one land in a single task.
    Every flight at a hot key has weather, so its buckets without any are dropped.
    """
    key = "time_interval"
    wcols = [c for c in weather.columns if c != key]
    distinct_rows = weather.groupBy(key, *wcols).agg(F.count(F.lit(1)).alias("_m"))
    per_key = distinct_rows.groupBy(key).agg(F.sum("_m").alias("_n"))
    hot = broadcast_if_small(per_key.where(F.col("_n") > hot_key_rows).select(key, F.lit(True).alias("_hot")),
                             limit_bytes)
    is_hot = F.coalesce(F.col("_hot"), F.lit(False))

    n_chunks = F.when(is_hot, F.ceil(F.col("_m") / F.lit(chunk_rows)).cast("int")).otherwise(F.lit(1))
    chunks = (distinct_rows.join(hot, on=key, how="left")
              .withColumn("_chunk", F.explode(F.sequence(F.lit(0), n_chunks - 1)))
              .withColumn("_cnt", F.when(is_hot, F.least(F.lit(chunk_rows).cast("long"), F.col("_m") - F.col("_chunk") * chunk_rows))
                          .otherwise(F.col("_m")).cast("int"))
              .withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(key, *wcols, "_chunk"), F.lit(buckets))).otherwise(F.lit(0)).cast("int"))
              .drop("_m", "_chunk", "_hot"))
    last = F.when(is_hot, F.lit(buckets - 1)).otherwise(F.lit(0))
    copies = (flights.join(hot, on=key, how="left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), last))))
    return (copies.join(chunks, on=[key, "_salt"], how="left")
            .where(~is_hot | F.col("_cnt").isNotNull())
            .withColumn("_rep", F.explode(F.array_repeat(F.lit(0), F.coalesce(F.col("_cnt"), F.lit(1)))))
            .drop("_salt", "_cnt", "_rep", "_hot"))


def weighted_weather(weather: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Weather reduced to one row per (key, attributes) with its multiplicity.

    Partial aggregation runs before the shuffle, and the result is bounded by
    grid keys x attribute values, however many observations share a key.
    """
    return weather.groupBy("time_interval", *attrs).agg(F.count(F.lit(1)).alias(WEIGHT))


def attach_weighted_weather(flights: DataFrame, weather: DataFrame, attrs: Sequence[str],
                            limit_bytes: int) -> DataFrame:
    """J1 without the fan-out: each flight meets each distinct weather tuple once,
    carrying how many observations it stands for; a flight with no weather
    keeps weight 1, exactly as the left join keeps it once."""
    w = broadcast_if_counted(weighted_weather(weather, attrs), limit_bytes)
    joined = flights.join(w, on="time_interval", how="left")
    return joined.withColumn(WEIGHT, F.coalesce(F.col(WEIGHT), F.lit(1).cast("long")))
