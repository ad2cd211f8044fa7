"""Counts of token pairs that two tokenizers link, by minimal perfect hashing.

1. Alignment. A text's tokens under A and B are byte ranges over the same bytes. The sorted union of their ends cuts the
   bytes into pieces, each inside one A and one B token: these are the links. Ends of both cut the tokens into groups.
2. Distinct pairs. Tasks encode the documents, store the ids, and emit the pairs of their documents with partial
   document counts (each pair once for each document). Spark finds the distinct pairs.
3. Hashing. Pairs are dealt to buckets of about ``BUCKET`` by hash. A task builds its bucket's minimal perfect hash: at each
   level, keys alone in a slot of a bit array keep it, others go on to the next; a key's index is the rank of its bit.
   The keys, in the order of their indices, are kept for verification.
4. Counts. Partial counts become dense vectors indexed by the hash, one for each bucket and part of the
   tasks; the parts' vectors are summed in a second step, and the largest count of each A id is taken.
5. Lookup. A second pass aligns the documents again and looks up each link's count; a key that does not
   verify is an error. At most ``CHUNK`` pairs travel to the tasks at a time; with more distinct pairs
   the pass is repeated for each chunk, and its sums are added up.

Defined cases: null and empty texts, and those that either tokenizer doesn't reproduce byte by byte, have no tokens (zeros, an
empty digest); repeated rows each count as a document; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windshear.llm.common import arrow_schema, map_rows, share, shuffle_parts, stored
from windshear.llm.transducer import BLANKS, byte_symbols

BUCKET = 1 << 16
CHUNK = 2_000_000
PART_ROWS = 1_000_000
PENDING = 500_000
SHIFT = 32
RUN = 500
BLANK_RUN = re.compile(rf"\s{{{RUN}}}")
ROOM = 2  # slots for each key of a level
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Codecs:
    """Both tokenizers, with the bytes of each token."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.quick = _by_rank(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        back = {c: i for i, c in enumerate(byte_symbols())}
        self.a_bytes = [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
                        for t in map(self.a.id_to_token, range(self.a.get_vocab_size()))]
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.vocab_size())]

    def _a_ids(self, text: str) -> list[int]:
        if self.quick and max(map(len, text.split()), default=0) < RUN and not BLANK_RUN.search(text):
            return self.quick.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """The ids of both; empty for a text that one of them does not reproduce."""
        if not text:
            return [], []
        x, y = self._a_ids(" " + text), self.b.encode(text)
        same = b"".join([self.a_bytes[i] for i in x]) == (" " + text).encode() == b"".join([self.b_bytes[i] for i in y])
        return (x, y) if same else ([], [])


def _by_rank(path: str):
    """The same byte-level vocabulary in the quicker library that merges by token rank, or None.

    Both give the same ids where merge number i makes token 256 + i: a token's rank is then the rank of
    the merge that makes it. (Were (a, bc) to make a token that the file makes of (ab, c), bc would have to be merged beside a
    before ab; then the file could never make it either.) That library slows down with the square of a piece's
    length, so texts with a run of ``RUN`` signs or blanks are left to the other one.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, cut = spec["model"]["vocab"], spec.get("pre_tokenizer") or {}
    made = ["".join(m) if not isinstance(m, str) else m.replace(" ", "") for m in spec["model"]["merges"]]
    if (spec.get("normalizer") or cut.get("type") != "ByteLevel" or not cut["use_regex"] or cut["add_prefix_space"]
            or [vocab.get(t) for t in made] != list(range(256, 256 + len(made))) or len(vocab) != 256 + len(made)):
        return None
    back = {c: i for i, c in enumerate(byte_symbols())}
    ranks = {bytes(back[c] for c in t): i for t, i in vocab.items()}
    return tiktoken.Encoding("a", pat_str=BLANKS, mergeable_ranks=ranks, special_tokens={})


def links(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray):
    """``(A indices, B indices)`` of the links, and the ends of A and B tokens."""
    a_end, b_end = np.cumsum(a_size[a]), np.cumsum(b_size[b])
    cuts = np.union1d(a_end, b_end)
    return np.searchsorted(a_end, cuts), np.searchsorted(b_end, cuts), a_end, b_end


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64((seed + 1) * int(_ODD) % 2 ** 64)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: bit arrays by level, and the rank of a key's bit."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        counts = [np.concatenate([[0], np.cumsum(bits, dtype=np.int64)]) for bits in levels]
        first = np.cumsum([0] + [int(c[-1]) for c in counts])
        self.ranks = [c[:-1] + f for c, f in zip(counts, first)]
        self.n = int(first[-1])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, levels = keys.astype(np.uint64), []
        while len(left):
            slot = (mixed(left, len(levels)) % np.uint64(ROOM * len(left))).astype(np.int64)
            bits = np.bincount(slot, minlength=ROOM * len(left)) == 1
            levels.append(bits)
            left = left[~bits[slot]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; any index or -1 for keys that were not built in."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        keys = keys.astype(np.uint64)
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            if not len(left):
                break
            slot = (mixed(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[slot]
            out[left[hit]] = rank[slot[hit]]
            left = left[~hit]
        return out

    def dump(self) -> tuple[list[int], bytes]:
        return [len(b) for b in self.levels], b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def load(cls, sizes: list[int], data: bytes) -> PerfectHash:
        levels, at = [], 0
        for n in sizes:
            width = -(-n // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, width, at), count=n).astype(bool))
            at += width
        return cls(levels)


def tokens(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``(doc_id, tkey, a, b)``: the ids of both tokenizers as 32-bit numbers; ``tkey`` tells texts apart."""
    state: list[Codecs] = []

    def run(cols):
        if not state:
            state.append(Codecs(a_path, b_path))
        got = [state[0].encode(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "tkey": cols["tkey"], "a": [_pack(x) for x, _ in got], "b": [_pack(y) for _, y in got]}

    return map_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("tkey")), run,
                    "doc_id long, tkey long, a binary, b binary", ["doc_id", "text", "tkey"], chunk=32)


def _pack(ids: list[int]) -> bytes:
    """Ids in 16 bits where they all fit, with a byte that says so."""
    small = not ids or max(ids) < 1 << 16
    return (b"\2" if small else b"\4") + np.array(ids, "<u2" if small else "<u4").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def pair_counts(table: DataFrame, sizes) -> DataFrame:
    """``(pair, h, n)``: partial document counts of the pairs ``a << 32 | b`` of each task's documents, and the
    hash of the pair by which buckets are dealt."""
    schema = "pair long, h long, n long"
    arrow = arrow_schema(table.sparkSession, schema)

    def merged(parts):
        pairs, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        return pairs, np.bincount(at, np.concatenate([n for _, n in parts]), len(pairs)).astype(np.int64)

    def rows(parts):
        pairs, n = merged(parts)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (pairs, pair_hash(pairs), n)], schema=arrow)

    def run(batches):
        a_size, b_size = sizes()
        held, pending, kept = [], 0, 0
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = _unpack(a), _unpack(b)
                if not len(a):
                    continue
                i, j, _, _ = links(a, b, a_size, b_size)
                own = np.unique(a[i] << SHIFT | b[j])
                held.append((own, np.ones(len(own), np.int64)))
                pending += len(own)
                if pending > PENDING:
                    held, pending = [merged(held)], 0
                    kept = len(held[0][0])
            if kept > 2 * PENDING:
                yield rows(held)
                held, pending, kept = [], 0, 0
        if held:
            yield rows(held)

    return table.select("a", "b").mapInArrow(run, schema)


HASHED = "bucket int, sizes array<long>, bits binary, keys binary"


def hash_tables(pairs: DataFrame, buckets: int) -> DataFrame:
    """One row for each bucket of the distinct ``pairs``: its perfect hash, and its keys in index order."""
    arrow = arrow_schema(pairs.sparkSession, HASHED)

    def build(table: pa.Table) -> pa.Table:
        keys = table.column("pair").to_numpy()
        made = PerfectHash.build(keys)
        ordered = np.empty(len(keys), np.int64)
        ordered[made.index(keys)] = keys
        sizes, bits = made.dump()
        return pa.Table.from_arrays([table.column("bucket")[:1], pa.array([sizes], pa.list_(pa.int64())), pa.array([bits], pa.binary()),
                                     pa.array([ordered.tobytes()], pa.binary())], schema=arrow)

    dealt = pairs.select("pair", bucket_of(buckets)).distinct()
    return dealt.repartition(_tasks(pairs.sparkSession, buckets), "bucket").groupBy("bucket").applyInArrow(build, HASHED)


def pair_hash(pairs: np.ndarray) -> np.ndarray:
    return mixed(pairs.astype(np.uint64), 99).view(np.int64)


def bucket_of(buckets: int):
    return F.pmod("h", F.lit(buckets)).cast("int").alias("bucket")


def _tasks(spark, groups: int) -> int:
    return min(20_000, max(shuffle_parts(spark), groups))


def dense_counts(partial: DataFrame, tables: DataFrame, buckets: int, parts: int) -> DataFrame:
    """``tables`` with ``counts``, the dense vector of each bucket's counts in index order."""
    vector = "bucket int, part int, counts binary"
    arrow = arrow_schema(partial.sparkSession, vector)
    # A partial row's part depends on its contents alone, so that a task run again deals it alike.
    rows = partial.select("pair", "n", bucket_of(buckets)).withColumn("part", F.pmod(F.hash("pair", "n"), F.lit(parts)))
    copies = tables.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def count(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows or not left.num_rows:
            return arrow.empty_table()
        made = PerfectHash.load(right.column("sizes")[0].as_py(), right.column("bits")[0].as_py())
        stored_keys = np.frombuffer(right.column("keys")[0].as_py(), np.int64)
        pairs = left.column("pair").to_numpy()
        at = made.index(pairs)
        if (at < 0).any() or (stored_keys[at] != pairs).any():
            raise RuntimeError("a pair is missing from its perfect hash")
        counts = np.bincount(at, left.column("n").to_numpy(), made.n).astype(np.int64)
        return pa.Table.from_arrays([right.column("bucket")[:1], right.column("part")[:1].cast(pa.int32()),
                                     pa.array([counts.tobytes()], pa.binary())], schema=arrow)

    n = _tasks(partial.sparkSession, buckets * parts)
    vectors = (rows.repartition(n, "bucket", "part").groupBy("bucket", "part")
               .cogroup(copies.repartition(n, "bucket", "part").groupBy("bucket", "part")).applyInArrow(count, vector))
    whole = "bucket int, counts binary"
    whole_arrow = arrow_schema(partial.sparkSession, whole)

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
        return pa.Table.from_arrays([table.column("bucket")[:1], pa.array([total.tobytes()], pa.binary())], schema=whole_arrow)

    summed = vectors.groupBy("bucket").applyInArrow(add, whole)
    return tables.join(summed, "bucket")


def best_counts(counted: DataFrame) -> DataFrame:
    """``(a, best)``: the largest count of each A id; at most one row for each id."""
    def run(cols):
        out = {"a": [], "best": []}
        for keys, counts in zip(cols["keys"], cols["counts"]):
            a, n = np.frombuffer(keys, np.int64) >> SHIFT, np.frombuffer(counts, np.int64)
            order = np.lexsort((n, a))
            last = np.flatnonzero(np.append(a[order][1:] != a[order][:-1], True))
            out["a"].extend(a[order][last].tolist())
            out["best"].extend(n[order][last].tolist())
        return out

    return map_rows(counted, run, "a long, best long", ["keys", "counts"], chunk=1).groupBy("a").agg(F.max("best").alias("best"))


class Lookup:
    """Counts of the pairs of some buckets."""

    def __init__(self, rows, buckets: int):
        self.tables = {r["bucket"]: (PerfectHash.load(r["sizes"], r["bits"]), np.frombuffer(r["keys"], np.int64),
                                     np.frombuffer(r["counts"], np.int64)) for r in rows}
        # All keys and counts in one vector each, and where each bucket's begin.
        self.start = np.zeros(buckets, np.int64)
        own = sorted(self.tables)
        sizes = [len(self.tables[b][1]) for b in own]
        self.start[own] = np.cumsum([0, *sizes[:-1]]) if own else 0
        self.keys = np.concatenate([self.tables[b][1] for b in own]) if own else np.empty(0, np.int64)
        self.counts = np.concatenate([self.tables[b][2] for b in own]) if own else np.empty(0, np.int64)
        self.tables = {b: t[0] for b, t in self.tables.items()}
        self.held = np.zeros(buckets, bool)
        self.held[own] = True

    def find(self, pairs: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """The counts of ``pairs`` whose buckets are all here."""
        out = np.empty(len(pairs), np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.r_[True, bucket[order][1:] != bucket[order][:-1]]) if len(pairs) else []
        for lo, hi in zip(edges, [*edges[1:], len(pairs)]):
            rows = order[lo:hi]
            at = self.tables[int(bucket[rows[0]])].index(pairs[rows]) + self.start[bucket[rows[0]]]
            if (self.keys[at] != pairs[rows]).any():
                raise RuntimeError("a pair is missing from its perfect hash")
            out[rows] = self.counts[at]
        return out


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _group_digest(a, b, a_end, b_end, both, table, n_a_ids) -> str:
    """The digest of the groups' ids, from the strings of each id with each separator."""
    last_a, last_b = np.isin(a_end, both, assume_unique=True), np.isin(b_end, both, assume_unique=True)
    group_a, group_b = np.searchsorted(both, a_end), np.searchsorted(both, b_end)
    strings = np.concatenate([2 * a + last_a, 2 * n_a_ids + 2 * b + last_b])
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    return hashlib.sha256("".join(table[strings[order]].tolist())[:-1].encode()).hexdigest()


def _look_up(table: DataFrame, sizes, lookup, best, buckets: int) -> DataFrame:
    """The alignment of each row, with the counts of the pairs that ``lookup`` holds."""
    schema = f"{ALIGNED}, tkey long"
    strings: list[np.ndarray] = []

    def run(cols):
        (a_size, b_size), here, top = sizes(), lookup(), best()
        if not strings:
            names = [f"{i}{c}" for i in range(len(a_size)) for c in ",|"] + [f"{i}{c}" for i in range(len(b_size)) for c in ",;"]
            strings.append(np.array(names, object))
        names = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        out = {"doc_id": cols["doc_id"], "tkey": cols["tkey"], "n_best": [], "count_sum": []} | {c: [] for c in names}
        held, pending = [], 0
        for a, b in zip(map(_unpack, cols["a"]), map(_unpack, cols["b"])):
            i, j, a_end, b_end = links(a, b, a_size, b_size)
            both = np.intersect1d(a_end, b_end, assume_unique=True)
            digest = _group_digest(a, b, a_end, b_end, both, strings[0], len(a_size)) if len(a) else ""
            for name, value in zip(names, (len(a), len(b), len(both), len(i), digest)):
                out[name].append(value)
            held.append(a[i] << SHIFT | b[j])
            pending += len(i)
            if pending > PENDING:
                _sum_up(held, here, top, buckets, out)
                held, pending = [], 0
        _sum_up(held, here, top, buckets, out)
        return out

    return map_rows(table, run, schema, ["doc_id", "tkey", "a", "b"], chunk=512)


def _sum_up(held: list[np.ndarray], here: Lookup, top: np.ndarray, buckets: int, out: dict[str, list]) -> None:
    """Adds ``n_best`` and ``count_sum`` of some documents' links; each distinct pair is looked up once."""
    if not held:
        return
    pairs, at = np.unique(np.concatenate(held), return_inverse=True)
    bucket = pair_hash(pairs) % buckets
    mine = here.held[bucket]
    counts = np.zeros(len(pairs), np.int64)
    counts[mine] = here.find(pairs[mine], bucket[mine])
    best = mine & (counts == top[pairs >> SHIFT])
    row = np.repeat(np.arange(len(held)), [len(x) for x in held])
    total = np.concatenate([[0], np.cumsum(counts[at])])
    ends = np.cumsum([len(x) for x in held])
    out["count_sum"].extend((total[ends] - total[ends - [len(x) for x in held]]).tolist())
    out["n_best"].extend(np.bincount(row[best[at]], minlength=len(held)).tolist())


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row for each of ``docs(doc_id, text)``: sizes of the alignment, and of its links the sum of their
    pairs' document counts, and how many have the largest count of their A id."""
    spark = docs.sparkSession
    codecs = Codecs(a_path, b_path)
    a_size, b_size = (np.array([len(t) for t in own], np.int64) for own in (codecs.a_bytes, codecs.b_bytes))
    sizes = share(spark, (a_size, b_size))
    table = stored(tokens(docs, a_path, b_path), "tokens")
    partial = stored(pair_counts(table, sizes), "pairs")
    rows, distinct = partial.agg(F.count("*"), F.count_distinct("pair")).first()
    buckets = max(1, -(-distinct // BUCKET))
    parts = max(1, -(-rows // (buckets * PART_ROWS)))
    tables = stored(hash_tables(partial, buckets), "hashes")
    counted = stored(dense_counts(partial, tables, buckets, parts), "counts")
    top = np.zeros(len(a_size), np.int64)  # one number for each id of A
    for r in best_counts(counted).collect():
        top[r["a"]] = r["best"]
    best = share(spark, top)
    chunk = max(1, CHUNK // BUCKET)
    frames = []
    for at in range(0, buckets, chunk):
        here = counted.where((F.col("bucket") >= at) & (F.col("bucket") < at + chunk)).collect()
        frames.append(_look_up(table, sizes, _held(spark, here, buckets), best, buckets))
    if len(frames) == 1:
        return frames[0].drop("tkey")
    sums = stored(frames[0], "aligned").groupBy("doc_id", "tkey").agg(F.max("n_best").alias("n_best"), F.max("count_sum").alias("count_sum"))
    first = frames[0].drop("n_best", "count_sum")
    for frame in frames[1:]:
        part = stored(frame.select("doc_id", "tkey", "n_best", "count_sum"), "aligned")
        sums = sums.union(part.groupBy("doc_id", "tkey").agg(F.max("n_best"), F.max("count_sum")))
    key = F.struct("doc_id", "tkey")
    total = sums.groupBy(key.alias("_key")).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return first.withColumn("_key", key).join(total, "_key").select([c.split()[0] for c in ALIGNED.split(", ")])


def _held(spark, rows, buckets: int):
    """A getter of the lookup of some buckets' rows inside tasks; they hold ``CHUNK`` pairs or so."""
    get = share(spark, [r.asDict() for r in rows])
    made: list[Lookup] = []

    def lookup() -> Lookup:
        if not made:
            made.append(Lookup(get(), buckets))
        return made[0]

    return lookup
