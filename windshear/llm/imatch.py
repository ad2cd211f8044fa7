"""I-Match fingerprints over randomised lexicon subsets.

The lexicon holds the terms whose document frequency is between ``RARE`` and
``COMMON`` of all documents, a band of inverse document frequencies. As no
document adds more than its distinct terms to the frequencies, it has at most
(mean distinct terms) / ``RARE`` entries, however large the corpus; its size is checked
before it is broadcast. A document's sorted distinct terms in the lexicon are
hashed once for each of 64 random subsets of the lexicon, which keep a quarter to
1/2048 of it (``RATES``), all at once as sums of term hashes, which depend on the set of terms alone as
a hash of their sorted sequence does: coarse subsets tell copies apart, fine ones survive edits. A
fingerprint is the row of these hashes, 8 hex digits each; its likeness to another is
the share of equal hashes among the subsets in which either document has terms.

A term is a run of characters other than space and \\t..\\r, with A-Z lowered.

Defined cases: null and empty texts have the fingerprint of no terms, alike (1) to
each other and unlike (0) to others; a document without any lexicon term is
fingerprinted over all its terms; equal texts have equal fingerprints; rows of equal id
follow each other by the hash of their texts, null ids come last; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from windshear.llm.common import arrow_schema, ascii_words, map_rows, share, shuffle_parts

RARE, COMMON = 0.0005, 0.25
RATES = ((1 / 4, 8), (1 / 32, 20), (1 / 256, 28), (1 / 2048, 8))  # share of the lexicon kept, number of such subsets
LEXICON_LIMIT = 20_000_000
_ODD = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_LIMITS = np.array([int(r * 2 ** 64) for r, n in RATES for _ in range(n)], np.uint64)
_SEEDS = np.array([(s + 1) * _ODD % 2 ** 64 for s in range(len(_LIMITS))], np.uint64)


def terms_of(text: str | None) -> np.ndarray:
    """The sorted distinct 63-bit hashes of the text's terms."""
    words = set(ascii_words(text))
    return np.unique(np.fromiter((xxh3_64_intdigest(w) >> 1 for w in words), np.int64, len(words)))


def members(terms: np.ndarray) -> np.ndarray:
    """Which subsets keep which term: a (term, subset) matrix of 0 and 1."""
    return (_mix(terms.view(np.uint64)[:, None] + _SEEDS[None, :]) < _LIMITS[None, :]).astype(np.uint8)


def lexicon(docs: DataFrame, rare: float = RARE, common: float = COMMON) -> np.ndarray:
    """Sorted hashes of the terms in the band, from the document frequencies of all rows."""
    def count(cols):
        found = [terms_of(t) for t in cols["text"]]
        terms, n = np.unique(np.concatenate(found), return_counts=True)
        return {"term": terms, "n": n}

    total = docs.count()
    df = map_rows(docs, count, "term long, n long", ["text"], chunk=4096).groupBy("term").agg(F.sum("n").alias("n"))
    band = df.where((F.col("n") >= rare * total) & (F.col("n") <= common * total)).select("term")
    rows = band.limit(LEXICON_LIMIT + 1).toArrow()
    if rows.num_rows > LEXICON_LIMIT:
        raise ValueError(f"the lexicon has over {LEXICON_LIMIT} terms; raise the least document frequency")
    return np.sort(rows.column("term").to_numpy())


class Lexicon:
    """The sorted terms of the band and, packed to one bit per subset, the subsets that keep each."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        step = 100_000
        packed = [np.packbits(members(terms[i:i + step]), axis=1) for i in range(0, len(terms), step)]
        self.kept = np.concatenate(packed) if packed else np.empty((0, len(_SEEDS) // 8), np.uint8)


def fingerprint(text: str | None, lex: Lexicon) -> np.ndarray:
    """One 32-bit hash per lexicon subset, of the sum of its terms' hashes (the terms
    are distinct, so their order is of no account); 0 where the document has no term in it."""
    terms = terms_of(text)
    bits = None
    if len(terms) and len(lex.terms):
        at = np.minimum(np.searchsorted(lex.terms, terms), len(lex.terms) - 1)
        inside = lex.terms[at] == terms
        if inside.any():
            terms = terms[inside]
            bits = np.unpackbits(lex.kept[at[inside]], axis=1)
    if not len(terms):
        return np.zeros(len(_SEEDS), np.uint32)
    if bits is None:
        bits = members(terms)
    total = (_mix(terms.view(np.uint64))[:, None] * bits).sum(0, dtype=np.uint64)
    out = np.maximum(_mix(total + _SEEDS) >> np.uint64(32), np.uint64(1)).astype(np.uint32)
    return np.where(bits.any(0), out, np.uint32(0))


def as_text(f: np.ndarray) -> str:
    return f.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, empty_a: bool, empty_b: bool) -> float:
    either = (a != 0) | (b != 0)
    n = int(either.sum())
    if not n:
        return 1.0 if empty_a == empty_b else 0.0
    return float(((a == b) & either).sum() / n)


def neighbours(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` dealt to partitions of consecutive ids, in descending order, with
    the first row of the following ids (``tail``) after each run ``part``. Only the
    ids are read to find the runs; the texts move once."""
    runs = 4 * shuffle_parts(docs.sparkSession)
    ids = docs.where("doc_id IS NOT NULL").select("doc_id")
    cuts = ids.approxQuantile("doc_id", [i / runs for i in range(1, runs)], 1 / (4 * runs)) if runs > 1 else []
    cuts = sorted({int(c) for c in cuts})
    edges = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    # The run of an id: the number of cuts at or above it; null ids make the last run.
    part = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(
        F.size(F.filter(edges, lambda c: c >= F.col("doc_id")))).cast("int")
    placed = docs.select("doc_id", "text").withColumn("part", part)
    heads = (placed.groupBy("part").agg(F.max("doc_id").alias("doc_id")).orderBy("part").collect())
    pairs = [(heads[i]["part"], heads[(i + 1) % len(heads)]["part"], heads[(i + 1) % len(heads)]["doc_id"]) for i in range(len(heads))]
    goes = {to: (src, head) for src, to, head in pairs}  # at most one entry per run
    if not goes:
        return placed.withColumn("tail", F.lit(False)).withColumn("h", F.xxhash64("text"))
    spark = docs.sparkSession
    table = spark.createDataFrame([(to, src, head) for to, (src, head) in goes.items()], "part int, src int, head long")
    tails = placed.join(F.broadcast(table), "part").where(F.col("doc_id").eqNullSafe(F.col("head"))).select(
        "doc_id", "text", F.col("src").alias("part"), F.lit(True).alias("tail"))
    every = placed.withColumn("tail", F.lit(False)).unionByName(tails).withColumn("h", F.xxhash64("text"))
    return every.repartition(shuffle_parts(spark), "part").sortWithinPartitions(
        "part", "tail", F.col("doc_id").desc_nulls_last(), "h")


PRINTED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: its fingerprint, that of its edited text (the last third replaced by the
    start of the next document by descending id) and the likeness to it and to the next document."""
    get = share(docs.sparkSession, Lexicon(lexicon(docs)))
    arrow = arrow_schema(docs.sparkSession, PRINTED)

    def run(batches):
        lex = get()
        held = None  # the row that waits for its successor

        def finish(row, text, print_, lex):
            doc_id, _, own, mine = row
            cut = len(own) // 3
            edited = own[:len(own) - cut] + text[:cut]
            other = fingerprint(edited, lex)
            return (doc_id, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), as_text(mine), as_text(other),
                    likeness(mine, other, not own.strip(), not edited.strip()),
                    likeness(mine, print_, not own.strip(), not text.strip()))

        for batch in batches:
            done = []
            for doc_id, text, part, tail in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "tail"))):
                text = text or ""
                if held is None and tail:
                    continue  # further rows of the same first id
                print_ = fingerprint(text, lex)
                if held is not None:
                    done.append(finish(held, text, print_, lex))
                held = None if tail else (doc_id, part, text, print_)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)

    return neighbours(docs).select("doc_id", "text", "part", "tail").mapInArrow(run, PRINTED)
