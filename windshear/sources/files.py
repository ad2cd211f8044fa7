"""The raw CSV inputs, read with static all-text schemas (no inference)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windshear import schemas


def _csv(spark: SparkSession, path: str | list[str], schema) -> DataFrame:
    """Header CSV as text, the needed columns selected by header name.

    Files may carry more columns (the public flight files have about a
    hundred); nothing is inferred, every value stays text, and the parser
    materialises only the selected columns. ``path`` may be a list: each entry
    (a file or folder) is read by its own header, so column orders may differ
    between entries. Within an entry all files must share one header: Spark
    checks every file's and fails on another one, rather than reading it by
    position. A column missing from an entry is an error up front.
    """
    names = schema.fieldNames()
    parts = []
    for one in [path] if isinstance(path, str) else path:
        df = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False).csv(one))
        missing = [n for n in names if n not in df.columns]
        if missing:
            raise ValueError(f"{one}: missing columns {missing}")
        parts.append(df.select(*[F.col(f"`{n}`").cast("string").alias(n) for n in names]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


CORRUPT = "_corrupt_record"


def read_checked(spark: SparkSession, path: str | list[str], schema) -> tuple[DataFrame, DataFrame]:
    """S1-S4 with malformed rows set apart: ``(rows, quarantined)``.

    A row with fewer or more fields than its file's header, or with a broken quote, is not
    padded or cut: it goes to ``quarantined(file, record)`` with its file's name and its text. All columns are parsed for
    this, also those that are not selected.
    """
    rows, bad = [], []
    names = schema.fieldNames()
    for one in [path] if isinstance(path, str) else path:
        header = spark.read.option("header", True).csv(one).columns
        missing = [n for n in names if n not in header]
        if missing:
            raise ValueError(f"{one}: missing columns {missing}")
        full = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
        df = (spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
              .option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT).csv(one))
        # Spark reads the corrupt column only together with another one, whatever a caller selects.
        first = F.col(f"`{header[0]}`")
        both = F.length(F.concat_ws("", F.col(CORRUPT), first)) >= 0
        rows.append(df.where(F.col(CORRUPT).isNull() & both).select(*[F.col(f"`{n}`") for n in names]))
        bad.append(df.where(F.col(CORRUPT).isNotNull() & both).select(
            F.col("_metadata.file_path").alias("file"), F.col(CORRUPT).alias("record")))
    return reduce(DataFrame.unionByName, rows), reduce(DataFrame.unionByName, bad)


def quarantine(spark: SparkSession, path: str | list[str], schema, side_path: str) -> DataFrame:
    """The well-formed rows of ``path``; the others are appended to the side table at ``side_path``."""
    rows, bad = read_checked(spark, path, schema)
    bad.write.mode("append").parquet(side_path)
    return rows


def read_flights(spark: SparkSession, path) -> DataFrame:
    """Flight CSV files (header row)."""
    return _csv(spark, path, schemas.FLIGHT_RAW)


def read_weather(spark: SparkSession, path) -> DataFrame:
    """Weather station CSV; descriptor rows survive here and are dropped by F1."""
    return _csv(spark, path, schemas.WEATHER_RAW)


def read_airports(spark: SparkSession, path) -> DataFrame:
    """S3: airport code to coordinates (UTF-8 BOM, quoted commas and blanks are handled)."""
    return _csv(spark, path, schemas.AIRPORT_RAW)


def read_timezones(spark: SparkSession, path) -> DataFrame:
    """Airport code to IANA zone name."""
    return _csv(spark, path, schemas.TIMEZONE_RAW)


def object_store_conf(access_key: str, secret_key: str) -> dict[str, str]:
    """Session settings for an S3-compatible store, to pass to ``SparkSession.builder.config``.

    Credentials belong in the session (or the cluster's credential provider),
    never in code.
    """
    return {"spark.hadoop.fs.s3a.access.key": access_key, "spark.hadoop.fs.s3a.secret.key": secret_key}
