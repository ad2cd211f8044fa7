"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import windshear.llm
from windshear.session import scratch_path

# Functions and classes of this subpackage travel to the executors by value, so
# that Python workers need not have the package on their path.
cloudpickle.register_pickle_by_value(windshear.llm)

# A join side is broadcast only after its rows were counted and found to be at most this many.
BROADCAST_ROWS = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WRITTEN: list[str] = []


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared scratch folder."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    _WRITTEN.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders that operators of this process wrote; returns how many there were. Results that
    were not written or collected yet read from them, so a job calls this once it has its results."""
    conf, removed = spark._jsc.hadoopConfiguration(), 0
    while _WRITTEN:
        where = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        removed += bool(where.getFileSystem(conf).delete(where, True))
    return removed


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage is
    cut, and a lost executor re-reads a file instead of repeating the work."""
    spark = df.sparkSession
    path = new_scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def share(spark: SparkSession, value) -> Callable[[], object]:
    """Broadcast a value of bounded size; returns a getter for use inside tasks."""
    bc = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    loaded: list = []

    def get():
        if not loaded:
            loaded.append(cloudpickle.loads(bc.value))
        return loaded[0]

    return get


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than that many."""
    return df.limit(rows + 1).count() <= rows


def held_out(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 4, equals 2. A null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 4) == 2


def sliced(batches: Iterator[pa.RecordBatch], chunk: int = 512) -> Iterator[pa.RecordBatch]:
    """Every row of the batches in their order, at most ``chunk`` rows at a time, so that a task holds the Python values and
    the new columns of that many rows beside the batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, chunk):
            yield batch.slice(at, chunk)


def map_rows(df: DataFrame, fn: Callable[[dict[str, list], Callable[[str], list]], dict[str, list]],
             schema: str, inputs: list[str], chunk: int = 512) -> DataFrame:
    """Apply ``fn`` to column lists of at most ``chunk`` rows at a time.

    ``fn(columns)`` gets ``{name: list}`` for ``inputs`` and returns ``{name: list}``
    for the fields of ``schema``. Memory is bounded by one Arrow batch.
    """
    arrow = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, chunk):
            cols = {c: part.column(c).to_pylist() for c in inputs}
            out = fn(cols)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.select(*inputs).mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def ascii_words(text: str | None) -> list[bytes]:
    """Lower-case A-Z and split on space and \\t..\\r: the words ``[^\\x20\\x09-\\x0D]+`` as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
