"""Overwriting a published table so that readers always find a whole one.

A table is a folder of version folders and a pointer file. A writer fills a new
version folder and then swaps the pointer, one atomic rename: a job that fails
half-way leaves the old pointer and the old files as they are. The pointer lists layers:
a later layer may replace some days of the earlier ones, so that a rebuild of
a few days writes just these. Versions that neither the new nor the previous pointer names
are removed; the previous one stays for queries that still read it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

POINTER = "_current.json"


@dataclass
class Layer:
    """A version folder, and the days of it that later layers replace (None: the rows without a day)."""
    folder: str
    without: list[str | None] = field(default_factory=list)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _pointer(spark: SparkSession, path: str) -> dict | None:
    fs, where = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def layers(spark: SparkSession, path: str) -> list[Layer] | None:
    """The layers of the published version, or None where nothing was published."""
    found = _pointer(spark, path)
    return None if found is None else [Layer(f"{path}/{x['folder']}", x["without"]) for x in found["layers"]]


def publish(spark: SparkSession, path: str, write: Callable[[str], None], *,
            replaces: list[str | None] | None = None) -> str:
    """Run ``write`` on a new version folder, then make it the published version.

    With ``replaces`` the new folder holds just these days and is laid over the published
    ones; without, it replaces the whole table. Returns the new folder.
    """
    name = f"v-{uuid.uuid4().hex}"
    write(f"{path}/{name}")
    before = _pointer(spark, path)
    kept = [] if replaces is None or before is None else [Layer(**x) for x in before["layers"]]
    for layer in kept:
        layer.without = layer.without + [d for d in replaces if d not in layer.without]
    now = {"layers": [asdict(x) for x in [*kept, Layer(name)]]}
    _swap(spark, path, json.dumps(now))
    used = {x["folder"] for p in (now, before) if p for x in p["layers"]}
    fs, where = _fs(spark, path)
    for status in fs.listStatus(where):
        old = status.getPath().getName()
        if old.startswith("v-") and old.split(".")[0] not in used:
            fs.delete(status.getPath(), True)
    return f"{path}/{name}"


def _swap(spark: SparkSession, path: str, text: str) -> None:
    """Write the pointer beside the old one, then rename it over that."""
    jvm = spark._jvm
    fs, new = _fs(spark, f"{path}/_new-{uuid.uuid4().hex}.json")
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(new), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")), options)
