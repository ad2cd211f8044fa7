"""Benchmark decontamination with suffix arrays of the training text.

Every task concatenates the words of its documents to shards of about
``SHARD_WORDS`` words and numbers the words by the benchmark's vocabulary (0:
not in it). A shard's suffix array holds the suffixes that start with a word pair
of the benchmark; it is refined word by word, only where the binary searches
of the benchmark suffixes still have matches. After ``j`` words each search holds the range of
training suffixes that share its first ``j`` words. The range after a window's
length gives all places of the window; the last range that is not empty gives
the longest verbatim match and its place. The search goes on to the end of an item.

Words are runs of letters, digits and all characters beyond ASCII, with A-Z
lowered. A window is ``size`` consecutive words of an item; an item of fewer words,
but not none, is one window. A document word inside any window's place is hit.

The benchmark travels to the tasks in chunks of at most ``CHUNK_WORDS`` words,
so that memory stays bounded for a benchmark of any size; each chunk scans
the documents once, and the scan of one ends before the next is read. Of several chunks, Spark
merges the hit places by document.

Defined cases: null and empty texts and items have no words and match nothing;
repeated documents are each reported, repeated items each listed (equal ids
once); a null item id is left out of the list but its windows count as hits;
empty tables give no rows or no hits; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windshear.llm.common import arrow_schema, map_rows, share, stored

SHARD_WORDS = 400_000
CHUNK_WORDS = 2_000_000
# Letters lowered, digits and bytes beyond ASCII kept, everything else a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


@dataclass
class Probe:
    """A chunk of benchmark items: the word ids of all items end to end (each ended by
    0), with the item, the window length and the words left at each suffix."""
    vocab: dict[bytes, int]
    ids: np.ndarray
    item: np.ndarray
    window: np.ndarray
    left: np.ndarray
    names: list


def probe(items: list[tuple], size: int) -> Probe:
    vocab: dict[bytes, int] = {}
    ids, item, window, left, names = [], [], [], [], []
    for k, (name, text) in enumerate(items):
        ws = words(text)
        names.append(name)
        for at, w in enumerate(ws):
            ids.append(vocab.setdefault(w, len(vocab) + 1))
            item.append(k)
            # Suffixes shorter than a window only extend matches; -1: no window starts there.
            window.append(min(size, len(ws)) if at + min(size, len(ws)) <= len(ws) else -1)
            left.append(len(ws) - at)
        ids.append(0)
        item.append(k)
        window.append(-1)
        left.append(0)
    as_array = lambda v: np.array(v, np.int64)
    return Probe(vocab, as_array(ids), as_array(item), as_array(window), as_array(left), names)


def search(text_ids: np.ndarray, p: Probe):
    """Yields ``(depth, suffixes, ranges)`` per refinement: the training suffixes in
    order, and per live probe suffix ``(probe position, from, to)`` into them."""
    text = np.append(text_ids, np.zeros(1, np.int64))
    wide = np.int64(len(p.vocab) + 1)
    starts = np.flatnonzero((p.window > 0) | (p.left > 0))
    if not len(starts):
        return
    pairs = np.unique(p.ids[:-1] * wide + p.ids[1:])
    singles = np.unique(p.ids[(p.left == 1)])
    first, second = text[:-1], text[1:]
    key = first * wide + second
    at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
    # A suffix can only match if its first pair, or its first word as the last word of an item, is in the benchmark.
    live = (first > 0) & ((pairs[at] == key) | np.isin(first, singles))
    sa = np.flatnonzero(live)
    group = np.zeros(len(sa), np.int64)
    probe_group = np.zeros(len(starts), np.int64)
    depth = 0
    while len(sa) and len(starts):
        nxt = text[np.minimum(sa + depth, len(text) - 1)]
        ok = nxt > 0
        sa, group, nxt = sa[ok], group[ok], nxt[ok]
        more = p.left[starts] > depth
        starts, probe_group = starts[more], probe_group[more]
        if not len(sa) or not len(starts):
            return
        keys = group * wide + nxt
        order = np.argsort(keys, kind="stable")
        sa, keys = sa[order], keys[order]
        edge = np.r_[True, keys[1:] != keys[:-1]]
        heads = np.flatnonzero(edge)
        distinct = keys[heads]
        want = probe_group * wide + p.ids[starts + depth]
        hit = np.minimum(np.searchsorted(distinct, want), len(distinct) - 1)
        found = distinct[hit] == want
        starts, probe_group = starts[found], hit[found]
        depth += 1
        ends = np.append(heads[1:], len(sa))
        yield depth, sa, (starts, heads[probe_group], ends[probe_group])
        # Only groups that some probe still follows stay.
        followed = np.zeros(len(heads), bool)
        followed[probe_group] = True
        rank = np.cumsum(followed) - 1
        inside = np.cumsum(edge) - 1
        keep = followed[inside]
        sa, group = sa[keep], rank[inside[keep]]
        probe_group = rank[probe_group]


def match_shard(docs_words: list[list[bytes]], p: Probe):
    """Per document: the hit word mask, the item numbers with windows, and the longest
    match ``(words, position in the document, item number)``."""
    get = p.vocab.get
    lengths = [len(w) for w in docs_words]
    begin = np.cumsum([0] + [n + 1 for n in lengths])
    text = np.zeros(begin[-1] + 1, np.int64)
    for b, ws in zip(begin, docs_words):
        if ws:
            text[b:b + len(ws)] = np.fromiter((get(w, 0) for w in ws), np.int64, len(ws))
    cover = np.zeros(len(text) + 1, np.int64)
    # Documents share few different sets of items, so each set is kept once.
    sets: dict[frozenset, int] = {}
    own: list[set[int]] = [set() for _ in docs_words]
    longest = [(0, -1, -1) for _ in docs_words]
    for depth, sa, (at, lo, hi) in search(text, p):
        full = p.window[at] == depth
        if full.any():
            spans: dict[tuple[int, int], set] = {}
            for i, a, b in zip(p.item[at[full]].tolist(), lo[full].tolist(), hi[full].tolist()):
                spans.setdefault((a, b), set()).add(i)
            for (a, b), its in spans.items():
                number = sets.setdefault(frozenset(its), len(sets))
                pos = sa[a:b]
                np.add.at(cover, pos, 1)
                np.add.at(cover, pos + depth, -1)
                for d in np.unique(np.searchsorted(begin, pos, side="right") - 1).tolist():
                    own[d].add(number)
        # The range that is visited last is the longest; the smallest place and item win ties.
        if len(at) and depth >= 3:
            # Ranges of one depth are equal or apart: of the probes that share one, the smallest item stands for all.
            order = np.lexsort((p.item[at], lo))
            one = order[np.r_[True, lo[order][1:] != lo[order][:-1]]]
            size = hi[one] - lo[one]
            flat = np.repeat(lo[one] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
            pos, who = sa[flat], np.repeat(p.item[at[one]], size)
            doc = np.searchsorted(begin, pos, side="right") - 1
            order = np.lexsort((pos, doc))
            for k in order[np.r_[True, doc[order][1:] != doc[order][:-1]]].tolist():
                longest[doc[k]] = (depth, int(pos[k] - begin[doc[k]]), int(who[k]))
    known = list(sets)
    united = {key: frozenset().union(*(known[i] for i in key)) for key in set(map(frozenset, own))}
    items = [united[frozenset(x)] for x in own]
    inside = np.cumsum(cover) > 0
    return [(int(inside[b:b + n].sum()), inside[b:b + n], its, best)
            for b, n, its, best in zip(begin.tolist(), lengths, items, longest)]


def _chunks(benchmark: DataFrame):
    """The number of driver-sized chunks of the benchmark's items, and a reader of one chunk's items."""
    size = F.greatest(F.size(F.split(F.coalesce("text", F.lit("")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")), F.lit(1))
    total = benchmark.agg(F.sum(size)).first()[0] or 0
    n = -(-total // CHUNK_WORDS) or 1

    def items(k: int) -> list[tuple]:
        part = benchmark if n == 1 else benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        return [(r["item_id"], r["text"]) for r in part.select("item_id", "text").collect()]

    return n, items


MATCHED = "doc_id long, n_words long, n_hit long, items array<string>, longest long, longest_at long, longest_item string"


def _matches(docs: DataFrame, items: list[tuple], size: int, keep_only: bool) -> DataFrame:
    get_probe = share(docs.sparkSession, probe(items, size))
    schema = docs.schema if keep_only else MATCHED
    arrow = None if keep_only else arrow_schema(docs.sparkSession, MATCHED)

    def shards(batches):
        for batch in batches:
            held, at, n = [], 0, 0
            for i, t in enumerate(batch.column("text")):
                held.append(words(t.as_py()))
                n += len(held[-1])
                if n >= SHARD_WORDS:
                    yield batch.slice(at, i + 1 - at), held
                    held, at, n = [], i + 1, 0
            if held:
                yield batch.slice(at), held

    def run(batches):
        p = get_probe()
        for part, ws in shards(batches):
            found = match_shard(ws, p)
            if keep_only:
                yield part.filter(pa.array([f[0] == 0 for f in found], pa.bool_()))
                continue
            cols = [part.column("doc_id").to_pylist(), [len(w) for w in ws], [f[0] for f in found],
                    [sorted({str(p.names[i]) for i in f[2] if p.names[i] is not None}) for f in found],
                    [f[3][0] for f in found], [f[3][1] for f in found],
                    [None if f[3][2] < 0 or p.names[f[3][2]] is None else str(p.names[f[3][2]]) for f in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return (docs if keep_only else docs.select("doc_id", "text")).mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Per row of ``docs``: ``(doc_id, n_words, n_hit, items, longest, longest_at,
    longest_item)``; ``longest`` counts the words of the longest verbatim match of at
    least three words, at word ``longest_at``."""
    n, items = _chunks(benchmark)
    if n == 1:
        return _matches(docs, items(0), size, False)
    # Hits can overlap across chunks, so their places are merged by document.
    found = _found(docs, n, items, size, True).groupBy("doc_id", "h").agg(
        F.max("n_words").alias("n_words"), F.sum((F.col("chunk") == 0).cast("long")).alias("rows"),
        F.flatten(F.collect_set("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.max(F.struct("longest", (-F.col("chunk")).alias("first"), "longest_at", "longest_item")).alias("best"))

    def merge(cols):
        hits = []
        for spans in cols["spans"]:
            total, end = 0, 0
            for a, b in sorted((x["a"], x["b"]) for x in spans):
                total += max(0, b - max(a, end))
                end = max(end, b)
            hits.append(total)
        return {**{c: cols[c] for c in inputs if c != "spans"}, "n_hit": hits}

    inputs = ["doc_id", "n_words", "rows", "spans", "items", "longest", "longest_at", "longest_item"]
    merged = map_rows(found.select("*", "best.*"), merge, f"{MATCHED}, rows long", inputs)
    one = F.explode(F.sequence(F.lit(1), F.col("rows")))  # repeated documents are each reported
    return merged.withColumn("_row", one).drop("_row", "rows")


FOUND = ("doc_id long, h long, chunk long, n_words long, spans array<struct<a:long,b:long>>, items array<string>, "
         "longest long, longest_at long, longest_item string")


def _found(docs: DataFrame, n: int, items, size: int, all_rows: bool) -> DataFrame:
    """What each of ``n`` chunks finds, one chunk after another: hit places, items and the longest match of
    the documents with any; with ``all_rows`` the first chunk has every row."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    out = None
    for k in range(n):
        get = share(docs.sparkSession, probe(items(k), size))

        def run(cols, k=k, get=get):
            p, ws = get(), [words(t) for t in cols["text"]]
            rows = []
            for doc_id, h, w, (hit, mask, its, best) in zip(cols["doc_id"], cols["h"], ws, match_shard(ws, p)):
                if hit or best[0] or (all_rows and k == 0):
                    edges = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8))).reshape(-1, 2).tolist()
                    item = None if best[2] < 0 or p.names[best[2]] is None else str(p.names[best[2]])
                    rows.append((doc_id, h, k, len(w), [{"a": a, "b": b} for a, b in edges],
                                 sorted({str(p.names[i]) for i in its if p.names[i] is not None}), best[0], best[1], item))
            names = ["doc_id", "h", "chunk", "n_words", "spans", "items", "longest", "longest_at", "longest_item"]
            return {c: [r[i] for r in rows] for i, c in enumerate(names)}

        part = stored(map_rows(keyed, run, FOUND, ["doc_id", "h", "text"]), f"chunk-{k}")
        out = part if out is None else out.union(part)
    return out


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs`` without any window of the benchmark, columns unchanged."""
    n, items = _chunks(benchmark)
    if n == 1:
        return _matches(docs, items(0), size, True)
    hit = _found(docs, n, items, size, False).where(F.size("spans") > 0).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h")).distinct()
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_h")), "left_anti")
