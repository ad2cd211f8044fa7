"""Incremental mart maintenance with Structured Streaming.

The original job is a batch rebuild. Here the same operators (E1-E4) run over
a file stream of flight CSVs: each micro-batch is cleaned, joined with the
static weather and airport tables (stream-static left joins) and written with
the batch layout (S8) to a folder of its own, ``batch_id=<n>``, inside the mart. A
repeated batch overwrites its folder, so each file lands exactly once. The
checkpoint lives inside the mart by default; a mart with batches whose
checkpoint is gone is refused, since batch numbers would start again at 0.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from windshear import schemas
from windshear.config import HubConfig
from windshear.plans import etl
from windshear.sources.mart import BATCH_COLUMN, write_mart


def flight_stream(spark: SparkSession, path: str, *, file_schema: T.StructType | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 as a stream: flight CSV files appearing under ``path``.

    A stream needs the files' full column list up front (``file_schema``, all
    text; default: exactly the used columns). Headers are checked against it,
    so a file with other columns fails instead of being read by position.
    """
    schema = file_schema or schemas.FLIGHT_RAW
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path).select(*schemas.FLIGHT_RAW.fieldNames())


def mart_stream(flights_raw: DataFrame, weather_raw: DataFrame, airports_raw: DataFrame,
                zones_raw: DataFrame, cfg: HubConfig) -> DataFrame:
    """E1-E3 + P6 on a streaming flight input; weather and airports are static."""
    # A micro-batch holds few flights: the plain join, without the hot-key split of the batch job.
    return etl.build_mart(flights_raw, weather_raw, airports_raw, zones_raw, replace(cfg, hot_key_rows=None))


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def start_mart_stream(flights_raw: DataFrame, weather_raw: DataFrame, airports_raw: DataFrame,
                      zones_raw: DataFrame, cfg: HubConfig, mart_path: str, *,
                      checkpoint: str | None = None, available_now: bool = True,
                      name: str = "mart_ingest") -> StreamingQuery:
    """Start appending to the mart at ``mart_path``.

    ``available_now`` processes what has landed and stops (a scheduled
    incremental run); otherwise the query keeps running. The checkpoint
    defaults to ``_checkpoint`` inside the mart.
    """
    spark = flights_raw.sparkSession
    ckpt = checkpoint or f"{mart_path.rstrip('/')}/_checkpoint"
    if _exists(spark, f"{mart_path}/{BATCH_COLUMN}=0") and not _exists(spark, f"{ckpt}/metadata"):
        raise RuntimeError(f"the mart {mart_path} holds batches, but its checkpoint {ckpt} is missing")

    def land(batch: DataFrame, batch_id: int) -> None:
        write_mart(batch, f"{mart_path.rstrip('/')}/{BATCH_COLUMN}={batch_id}")

    writer = (mart_stream(flights_raw, weather_raw, airports_raw, zones_raw, cfg)
              .writeStream.foreachBatch(land).option("checkpointLocation", ckpt).queryName(name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
