"""The mart stored in two factors, so that its size grows with its inputs.

The flight side is stored once for each flight (partitioned by departure day), the weather side
once for each distinct observation of a grid key, with its multiplicity. The
pairs of D14, whose number grows with the square of the rows that share a key, are formed only on read:
as rows (``read_pairs``), or as weights that counts add up (``read_weighted``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windshear.config import HubConfig
from windshear.operators.joins import WEIGHT, broadcast_if_counted
from windshear.operators.projections import flight_side_projection
from windshear.plans import etl
from windshear.schemas import MART
from windshear.sources import versions
from windshear.sources.mart import DAY_COLUMN

KEY = "time_interval"
WEATHER_SIDE = [f for f in MART.fields if f.name in {"card_dir", "wind_dir", "wind_speed", "binned_wind", "crosswind", "crosswind_lim"}]


def write_factored(flights_raw: DataFrame, weather_raw: DataFrame, airports_raw: DataFrame, zones_raw: DataFrame,
                   cfg: HubConfig, path: str) -> str:
    """Publish both factors of the mart of these inputs; either all of it or nothing is swapped in."""
    flights = flight_side_projection(etl.localise_flights(etl.clean_flights(flights_raw, cfg), airports_raw, zones_raw, cfg))
    names = [f.name for f in WEATHER_SIDE]
    weather = etl.prepared_weather(weather_raw, cfg).select(KEY, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in WEATHER_SIDE])

    def write(folder: str) -> None:
        (flights.withColumn(DAY_COLUMN, F.to_date("dep_time")).hint("rebalance", DAY_COLUMN)
         .sortWithinPartitions(DAY_COLUMN, "dep_time").write.partitionBy(DAY_COLUMN).parquet(f"{folder}/flights"))
        (weather.groupBy(KEY, *names).agg(F.count(F.lit(1)).alias("n")).hint("rebalance", KEY)
         .sortWithinPartitions(KEY).write.parquet(f"{folder}/weather"))

    return versions.publish(flights_raw.sparkSession, path, write)


def read_factors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The stored flights and weather groups."""
    folder = versions.layers(spark, path)[-1].folder
    return spark.read.parquet(f"{folder}/flights"), spark.read.parquet(f"{folder}/weather")


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """The 24 mart columns and the day, one row for each pair, as ``read_mart`` gives them.

    A group's multiplicity is expanded after the join, row by row; a flight without weather stays once.
    """
    flights, weather = read_factors(spark, path)
    pairs = flights.join(weather, on=KEY, how="left")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("n", F.lit(1).cast("long"))))
    return pairs.withColumn("_at", each).select(*[f.name for f in MART.fields], DAY_COLUMN)


def read_weighted(spark: SparkSession, path: str, attrs: Sequence[str], limit_bytes: int = 64 << 20) -> DataFrame:
    """The flight columns with only the weather ``attrs``, each row with the number
    of mart rows it stands for (``n_obs``); the questions add these up (``weight=WEIGHT``)."""
    flights, weather = read_factors(spark, path)
    groups = weather.groupBy(KEY, *attrs).agg(F.sum("n").alias(WEIGHT))
    joined = flights.join(broadcast_if_counted(groups, limit_bytes), on=KEY, how="left")
    return joined.withColumn(WEIGHT, F.coalesce(F.col(WEIGHT), F.lit(1).cast("long"))).drop(KEY)
