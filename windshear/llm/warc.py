"""WARC archives: writing pages, and reading with boundary-chain verification.

Writing. Every row becomes one record of uncompressed WARC 1.1. Of rows with equal payloads of at least
``LEAST_REVISIT`` bytes the one of the smallest id is a ``response``; the
others are ``revisit`` records that refer to it and hold no payload. The text
writer stores record bytes as they are, one archive per task.

Reading. The magic ``WARC/1.1`` with its line end may also occur inside payloads. Tasks scan byte
ranges of the archives; every magic is a candidate record that names, by its
header length and ``Content-Length``, the offset of its successor. Pointer jumping
from offset 0 of each archive doubles the span of the pointers each round and keeps
the reachable candidates: the true records. Payloads that contain the magic, and so lie in several pieces,
are put together in a second scan that moves only their pieces.

Offsets are exact: the scan cuts the archive at each magic, every piece's length
is known, and lengths are summed over the ranges of an archive; a total that
differs from the archive's size, or a chain that breaks off before its end, raises an error.

Defined cases: a null html is an empty payload; a null url is left out of the
header, line ends and control characters in it are percent-encoded; a null id is
written as ``-`` and read as null; rows that repeat the smallest id with an equal
payload are all responses; an empty table gives no archive and no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from windshear.llm.common import arrow_schema, new_scratch, small_enough, stored

LEAST_REVISIT = 100
MAGIC = b"WARC/1.1\r\n"
_END = re.compile(rb"\r\n\r\n")
_FIELD = re.compile(rb"([A-Za-z-]+):[ \t]*([^\r\n]*)\r\n")


def first_holders(pages: DataFrame) -> DataFrame:
    """``(digest, refers_to)``: the smallest id of each payload that several rows hold."""
    known = pages.select("page_id", F.coalesce("html", F.lit("")).cast("binary").alias("b")).select(
        "page_id", F.sha2("b", 256).alias("digest"), F.octet_length("b").alias("n"))
    return (known.where(F.col("n") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("c"))
             .where("c > 1").select("digest", "refers_to"))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``pages(page_id, url, html)`` as WARC files below ``path``."""
    firsts = stored(first_holders(pages), "firsts")
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("digest"),
                        F.octet_length(payload).alias("n"))
    # The first ids of repeated payloads are few against the pages; they are broadcast only if counted as such.
    rows = rows.join(F.broadcast(firsts) if small_enough(firsts) else firsts, "digest", "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("refers_to").eqNullSafe(F.col("page_id"))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    ident = F.coalesce(F.col("page_id").cast("string"), F.lit("-"))
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), r"[\x00-\x1F\x7F]", "%20")
    header = F.concat(
        F.lit(MAGIC.decode()),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), ident, F.lit(">"))),
        field("WARC-Date", F.lit(date)),
        F.coalesce(field("WARC-Target-URI", url), F.lit("")),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                                 field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
                                 field("WARC-Truncated-Length", F.col("n").cast("string")))).otherwise(""),
        field("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n")).cast("string")))
    # The writer adds the last line feed of the record's end.
    record = F.concat(header, F.lit("\r\n"), F.when(revisit, "").otherwise(F.col("payload")), F.lit("\r\n\r"))
    rows.select(record.alias("value")).write.option("lineSep", "\n").text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at each magic: ``(file, size, block, value)``; rows of a range in order."""
    return (spark.read.option("lineSep", MAGIC.decode()).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                    F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")))


CANDIDATE = ("file string, size long, block long, rel long, len long, head long, content long, type string, "
             "page_id long, refers_to long, stated string, bytes long, digest string")


def header_fields(piece: bytes) -> tuple[int, dict[bytes, bytes]] | None:
    """Length of a record's header after the magic, with the blank line, and its fields."""
    end = _END.search(piece)
    if end is None:
        return None
    fields = {m.group(1).lower(): m.group(2) for m in _FIELD.finditer(piece, 0, end.start() + 2)}
    return end.end(), fields


def _page(value: bytes | None) -> int | None:
    m = re.fullmatch(rb"<urn:page:(-?\d{1,19})>", value or b"")
    return int(m.group(1)) if m else None


def _scan(pieces: DataFrame) -> DataFrame:
    """One row per piece: its place in its range, and the candidate record that starts before it."""
    arrow = arrow_schema(pieces.sparkSession, CANDIDATE)

    def run(batches):
        at, where = 0, None
        for batch in batches:
            out = []
            for file, size, block, piece in zip(*(batch.column(c).to_pylist() for c in ("file", "size", "block", "value"))):
                if where != (file, block):
                    at, where = 0, (file, block)
                got = header_fields(piece)
                head, content, f = (-1, -1, {}) if got is None else (got[0], got[1].get(b"content-length", b""), got[1])
                content = int(content) if isinstance(content, bytes) and re.fullmatch(rb"\d{1,15}", content) else -1
                # The payload is whole if the piece holds it and the record's end.
                whole = content >= 0 and len(piece) == head + content + 4
                body = piece[head:head + content] if whole else b""
                stated = f.get(b"warc-payload-digest", b"").removeprefix(b"sha256:").decode("ascii", "replace")
                full = f.get(b"warc-truncated-length", b"")
                kind = f.get(b"warc-type", b"").decode("ascii", "replace")
                revisit = kind == "revisit"
                out.append((file, size, block, at, len(piece), head, content, kind, _page(f.get(b"warc-record-id")),
                            _page(f.get(b"warc-refers-to")), stated,
                            int(full) if revisit and full.isdigit() else content,
                            stated if revisit else hashlib.sha256(body).hexdigest() if whole else None))
                at += len(piece) + len(MAGIC)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return pieces.mapInArrow(run, CANDIDATE)


def _offsets(scanned: DataFrame) -> DataFrame:
    """The candidates with ``off``, the offset of their magic, and ``next``, their successor's; null at the archive's end."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    step = len(MAGIC)
    blocks = scanned.groupBy("file", "size", "block").agg(F.sum(F.col("len") + step).alias("n"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
                           (F.sum("n").over(whole) - step).alias("total"), "size")
    wrong = F.raise_error(F.concat(F.lit("archive scanned incompletely: "), F.col("file"))).cast("long")
    blocks = blocks.select("file", "block", F.when(F.col("total") != F.col("size"), wrong).otherwise(F.col("base")).alias("base"))
    # A piece follows its magic; the first piece, before the first magic, is no candidate.
    off = F.col("base") + F.col("rel") - step
    end = F.col("off") + step + F.col("head") + F.col("content") + 4
    return (scanned.join(blocks, ["file", "block"]).withColumn("off", off)
            .withColumn("next", F.when((F.col("content") >= 0), end)))


def reachable(pointers: DataFrame) -> DataFrame:
    """The ``(file, off)`` on the chain from offset 0, for ``pointers(file, size, off, next)``, by pointer jumping.
    A chain that does not end at the archive's size raises an error."""
    jump = stored(pointers.select("file", "off", F.when(F.col("next") < F.col("size"), F.col("next")).alias("next"),
                                  F.coalesce(F.col("next") <= F.col("size"), F.lit(False)).alias("sound"), "size"), "jump")
    reached = stored(jump.where("off = 0").select("file", "off"), "reached")
    links = jump.where("next IS NOT NULL").select("file", "off", "next")
    while True:
        more = reached.join(links, ["file", "off"]).select("file", F.col("next").alias("off"))
        reached = stored(reached.union(more).distinct(), "reached")
        links = stored(links.join(links.select("file", F.col("off").alias("next"), F.col("next").alias("far")), ["file", "next"])
                       .select("file", "off", F.col("far").alias("next")), "links")
        if links.join(reached, ["file", "off"], "left_semi").isEmpty():
            break
    broken = jump.where("NOT sound").join(reached, ["file", "off"], "left_semi").select("file", "off")
    found = reached.join(jump.select("file", "off"), ["file", "off"], "left_semi")
    if not broken.isEmpty() or found.count() != reached.count():
        raise ValueError("an archive's chain of records breaks off before its end")
    return found


def _gathered(spark: SparkSession, path: str, candidates: DataFrame, true: DataFrame, split: DataFrame) -> DataFrame:
    """``(file, off, body_digest)`` of records whose payload holds the magic, from their pieces."""
    # Each piece belongs to the last true record at or before it; only numbers are sorted, per archive.
    mark = split.select("file", "off", F.struct(F.col("off").alias("record"), "head", "content", F.lit(True).alias("wanted")).alias("r"))
    true = true.join(mark, ["file", "off"], "left").select("file", "off", F.coalesce(
        "r", F.struct(F.col("off").alias("record"), F.lit(0).cast("long").alias("head"), F.lit(0).cast("long").alias("content"),
                      F.lit(False).alias("wanted"))).alias("r"))
    upto = Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    inside = (candidates.select("file", "block", "rel", "off").join(true, ["file", "off"], "left")
              .withColumn("r", F.last("r", ignorenulls=True).over(upto)))
    want = stored(inside.where("r.wanted").select("file", "block", "rel", F.col("off").alias("p"), "r.record", "r.head", "r.content"), "pieces")
    arrow = arrow_schema(spark, "file string, block long, rel long, value binary")

    def placed(batches):
        at, where = 0, None
        for batch in batches:
            rel = []
            for file, block, piece in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("value")):
                if where != (file, block):
                    at, where = 0, (file, block)
                rel.append(at)
                at += len(piece.as_py()) + len(MAGIC)
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array(rel, pa.int64()),
                                              batch.column("value").cast(arrow.field("value").type)], schema=arrow)

    pieces = _pieces(spark, path).mapInArrow(placed, "file string, block long, rel long, value binary")
    parts = pieces.join(F.broadcast(want) if small_enough(want) else want, ["file", "block", "rel"])
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p", F.hex("value").alias("v")))), lambda x: x["v"]),
                        MAGIC.hex().upper())
    whole = parts.groupBy("file", "record", "head", "content").agg(text.alias("hex"))
    body = F.unhex(F.substring(F.col("hex"), F.col("head") * 2 + 1, F.col("content") * 2))
    return whole.select("file", F.col("record").alias("off"), F.sha2(body, 256).alias("body_digest"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, file, off, digest_ok)`` per record."""
    scanned = stored(_scan(_pieces(spark, path)), "scan")
    candidates = stored(_offsets(scanned).where("off >= 0"), "candidates")
    true = reachable(candidates.select("file", "size", "off", "next"))
    records = stored(candidates.join(true, ["file", "off"], "left_semi"), "records")
    split = records.where("digest IS NULL")
    if not split.isEmpty():
        whole = _gathered(spark, path, candidates, true, split)
        records = records.join(whole, ["file", "off"], "left").withColumn("digest", F.coalesce("digest", "body_digest"))
    return records.select("page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                          F.col("type").alias("record_type"), "refers_to", "file", "off",
                          (F.col("digest") == F.col("stated")).alias("digest_ok"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to the shared scratch folder and read the archives back."""
    spark = pages.sparkSession
    path = new_scratch(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)
