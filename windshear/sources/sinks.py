"""JDBC table sink, inspection, JSON results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jdbc(df: DataFrame, url: str, table: str, *, user: str | None = None,
               password: str | None = None, truncate: bool = True, mode: str = "overwrite",
               num_partitions: int | None = None, batch_size: int = 10000) -> None:
    """Overwrite a database table, keeping its definition (``truncate``).

    ``num_partitions`` caps concurrent connections; the rows are dealt anew, so
    that the work before keeps its own parallelism.
    """
    out = df.repartition(num_partitions) if num_partitions else df
    w = (out.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("truncate", str(truncate).lower()).option("batchsize", batch_size).mode(mode))
    if user is not None:
        w = w.option("user", user)
    if password is not None:
        w = w.option("password", password)
    w.save()


def preview(df: DataFrame, n: int = 20, *, by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows for a look (the limit is the feature here); with
    ``by`` the first in that order, NULLs first, so the pick is the same each time."""
    return (df.orderBy(*[F.col(c).asc_nulls_first() for c in by]) if by else df).limit(n)


def schema_text(df: DataFrame) -> str:
    """The schema, one ``name: type`` line per column."""
    return "\n".join(f"{name}: {kind}" for name, kind in df.dtypes)


def as_json_lines(df: DataFrame) -> DataFrame:
    """Each result row as one JSON object (column ``json``)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A result as JSON lines, written by the executors."""
    df.write.mode(mode).json(path)


def columns_json(df: DataFrame, most: int = 20_000) -> dict:
    """The column-oriented ``{column: {row: value}}`` shape a dashboard reads.

    Driver-side: only for aggregated results; more than ``most`` rows raise an error.
    """
    pdf = df.limit(most + 1).toPandas()
    if len(pdf) > most:
        raise ValueError(f"columns_json is for results of at most {most} rows")
    return {c: {str(i): v for i, v in enumerate(pdf[c].tolist())} for c in pdf.columns}
