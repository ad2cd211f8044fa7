"""Near-duplicate documents by HyperMinHash.

1. Sets. A text's distinct shingles of ``words`` words become 64-bit hashes.
   Equal sets (128-bit digest) form one class; only class representatives go on.
2. Sketches. ``REPEATS`` HyperMinHash sketches of ``BUCKETS`` registers each: a
   rehash picks a register by its top bits, the smallest remainder in it is kept as
   leading-zero count (6 bits) and ``MANTISSA`` further bits, 16 bits in all.
3. Bands. Runs of ``ROWS`` registers of a sketch, with at least one used, are
   band keys. At similarity 0.8 a pair shares none of the 50 bands with
   probability 2.5e-7, at 0.85 5e-11.
4. Links. Within a band key every class is compared with a leader of the
   key: first by the collision-corrected Jaccard estimate of the sketches (down to
   ``SIGMAS`` standard deviations below the limit; of pairs at the limit 3e-7 are lost), then on the full sets.
5. Rest. Connected components follow. Only band keys whose classes still lie
   in several components go on, and of these only classes with enough shingles
   that another such class has. In rounds, up to ``LEADERS`` classes outside the
   key's largest component meet all members of other components that can share
   enough with them, by those counts, by ``MARKS`` bits set by their shingles, which bound what two sets share, and by the
   lowest bits of their registers, and then leave the key, until each key holds one component.
   So a group of copies costs links in proportion to its rows, and every pair
   that shares a key and could join two components is tested.

Defined cases: null, empty and blank texts have no shingles and are linked with
nothing; a text of fewer words has its whole word sequence as the only shingle; repeated
rows fall together by their sets; classes are keyed by the digest of their set, so an id with several
texts has a component for each of them, and none of their links is lost; a null id gets no component other than
null; an empty table gives no rows; extra columns are ignored by ``near_duplicates``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from windshear.llm.common import arrow_schema, ascii_words, map_rows, small_enough, stored
from windshear.llm.components import components

REPEATS, BUCKETS, ROWS, MANTISSA = 5, 64, 6, 10
BANDS = BUCKETS // ROWS
EMPTY = np.uint16(0xFFFF)
LEADERS = 512
PARTNERS = 64
PART = 1024
WORDS_HELD = 50_000
PLANES = 4
MARKS = 4096
SIGMAS = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3's)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, words: int, memo: dict[bytes, int]) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    toks = ascii_words(text)
    if not toks:
        return np.empty(0, np.uint64)
    h = np.fromiter((memo[w] if w in memo else _word(w, memo) for w in toks), np.uint64, len(toks))
    if len(toks) < words:
        return np.array([int.from_bytes(hashlib.blake2b(b" ".join(toks), digest_size=8).digest(), "little")], np.uint64)
    n = len(toks) - words + 1
    out = np.zeros(n, np.uint64)
    for k in range(words):
        out = mix(out * _ODD + h[k:k + n])
    return np.unique(out)


def _word(w: bytes, memo: dict[bytes, int]) -> int:
    if len(memo) > WORDS_HELD:
        memo.clear()
    v = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
    memo[w] = v
    return v


def sketch(hashes: np.ndarray) -> np.ndarray:
    """``REPEATS * BUCKETS`` registers of 16 bits; EMPTY where no hash fell."""
    out = np.full(REPEATS * BUCKETS, EMPTY, np.uint16)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    for r in range(REPEATS):
        v = np.sort(mix(hashes + np.uint64((r + 1) * int(_ODD) % 2 ** 64)))
        bucket = (v >> shift).astype(np.int64)
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        rest = (v[first] & ((np.uint64(1) << shift) - np.uint64(1))) | np.uint64(1)
        # The exponent of the remainder is its number of leading zeros read from the other end.
        bits = rest.astype(np.float64).view(np.uint64) >> np.uint64(52 - MANTISSA)
        exponent = (bits >> np.uint64(MANTISSA)) - np.uint64(1023)
        zeros = np.uint64(64 - BUCKETS.bit_length()) - np.minimum(exponent, np.uint64(64 - BUCKETS.bit_length()))
        reg = (zeros << np.uint64(MANTISSA)) | (bits & np.uint64((1 << MANTISSA) - 1))
        out[r * BUCKETS + bucket[first]] = reg.astype(np.uint16)
    return out


def band_keys(registers: np.ndarray) -> list[int]:
    """64-bit keys of the bands that hold a used register."""
    used = registers.reshape(REPEATS, BUCKETS)[:, :BANDS * ROWS].reshape(REPEATS * BANDS, ROWS)
    key = np.arange(len(used), dtype=np.uint64) + np.uint64(1)
    for k in range(ROWS):
        key = mix(key * _ODD + used[:, k].astype(np.uint64))
    return key[(used != EMPTY).any(1)].view(np.int64).tolist()


def estimate(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> tuple[float, int]:
    """Jaccard estimate from two sketches, less expected register collisions, and
    the number of registers used by either."""
    either = (a != EMPTY) | (b != EMPTY)
    used = int(either.sum())
    if not used:
        return 0.0, 0
    same = int(((a == b) & either).sum())
    # Chance that two unrelated minima agree in leading zeros and mantissa, after Yu and Weber.
    ratio = max(n_a, n_b) / min(n_a, n_b)
    chance = 0.169919487159739093975 * 4 * ratio / (1 + ratio) ** 2 * 2.0 ** -MANTISSA * 6
    return max(0.0, (same - chance * used) / ((1 - chance) * used)), used


def marks(hashes: np.ndarray) -> tuple[list[int], int]:
    """One of ``MARKS`` bits for each shingle, in 64-bit words, and how many shingles set no bit of their own."""
    bits = np.zeros(MARKS, np.uint8)
    bits[(mix(hashes) % np.uint64(MARKS)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64).tolist(), len(hashes) - int(bits.sum())


def planes(registers: np.ndarray) -> list[int]:
    """The lowest ``PLANES`` bits of all registers as bit planes, in 64-bit words."""
    bits = (registers[None, :] >> np.arange(PLANES, dtype=np.uint16)[:, None]) & np.uint16(1)
    return np.packbits(bits.astype(np.uint8), axis=1).reshape(-1).view(np.int64).tolist()


def most_differing(limit: float) -> float:
    """Registers whose kept bits differ, at most, for a similarity of ``limit``: ``SIGMAS`` deviations above the mean."""
    p = (1 - limit) * (1 - 2.0 ** -PLANES)
    n = REPEATS * BUCKETS
    return n * p + SIGMAS * (n * p * (1 - p)) ** 0.5


def sketch_table(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, tkey, n, digest, registers)`` per row of ``docs(doc_id, text)``; ``tkey`` is a hash of the
    text, by which the text of a row is found again."""
    memo: dict[bytes, int] = {}

    def run(cols):
        out = {"doc_id": cols["doc_id"], "tkey": cols["tkey"], "n": [], "digest": [], "registers": []}
        for t in cols["text"]:
            s = shingles(t, words, memo)
            out["n"].append(len(s))
            out["digest"].append(_digest(s) if len(s) else None)
            out["registers"].append(sketch(s).tobytes() if len(s) else None)
        return out

    return map_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("tkey")), run,
                    "doc_id long, tkey long, n long, digest binary, registers binary", ["doc_id", "text", "tkey"])


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _bands(classes: DataFrame) -> DataFrame:
    def run(cols):
        out = {"band": [], "id": []}
        for i, r in zip(cols["id"], cols["registers"]):
            keys = band_keys(np.frombuffer(r, np.uint16))
            out["band"].extend(keys)
            out["id"].extend([i] * len(keys))
        return out

    return map_rows(classes, run, "band long, id long", ["id", "registers"])


def _meet(pairs: DataFrame, data: DataFrame, test) -> DataFrame:
    """The ``pairs(a, b)`` that ``test(n_a, data_a, n_b, data_b)`` accepts, given ``data(id, n, data)``.

    The partners of an id ``a`` are cut into chunks of about ``PARTNERS``; into each chunk the
    data of ``a`` travel once, ahead of the partners' own, and a task holds those of one ``a`` at a time.
    So an id with very many partners is spread over many tasks, and no joined row holds two data."""
    many = pairs.groupBy("a").agg(F.count("*").alias("k")).where(F.col("k") > PARTNERS).select(
        "a", F.ceil(F.col("k") / PARTNERS).alias("chunks"))
    chunks = F.coalesce("chunks", F.lit(1))
    dealt = (pairs.join(F.broadcast(many) if small_enough(many) else many, "a", "left")
             .select("a", "b", F.pmod(F.xxhash64("b"), chunks).alias("chunk")))
    lead = dealt.select("a", "chunk").distinct()
    rows = (dealt.join(data, dealt["b"] == data["id"]).select("a", "chunk", "b", "n", "data")
            .unionByName(lead.join(data, lead["a"] == data["id"]).select(
                "a", "chunk", F.lit(None).cast("long").alias("b"), "n", "data")))
    schema = "a long, b long"
    arrow = arrow_schema(pairs.sparkSession, schema)

    def run(batches):
        at, n, held = None, 0, b""
        for batch in batches:
            out = {"a": [], "b": []}
            key, own, other, size = (batch.column(c).to_pylist() for c in ("a", "chunk", "b", "n"))
            column = batch.column("data")
            for i in range(batch.num_rows):
                if other[i] is None:
                    at, n, held = (key[i], own[i]), size[i], column[i].as_py()
                elif at == (key[i], own[i]) and test(n, held, size[i], column[i].as_py()):
                    out["a"].append(key[i])
                    out["b"].append(other[i])
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return (rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
            .mapInArrow(run, schema))


def _likely(pairs: DataFrame, classes: DataFrame, limit: float) -> DataFrame:
    """The pairs ``(a, b)`` whose sketches do not rule the similarity out."""
    def test(na, ra, nb, rb):
        if min(na, nb) < limit * max(na, nb) - 1e-9:
            return False
        j, used = estimate(np.frombuffer(ra, np.uint16), np.frombuffer(rb, np.uint16), na, nb)
        return j >= limit - SIGMAS * (limit * (1 - limit) / max(1, used)) ** 0.5

    return _meet(pairs, classes.select("id", "n", F.col("registers").alias("data")), test)


def _sets(docs: DataFrame, classes: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``(id, n, data)`` for the wanted classes, ``data`` the sorted shingle hashes, from the text of each class's first
    row. The wanted rows are a few longs each and broadcast only if counted as few."""
    want = classes.join(ids, "id", "left_semi").select(F.col("doc_id").alias("_d"), F.col("tkey").alias("_t"), "id", "digest")
    texts = docs.select(F.col("doc_id").alias("_d"), "text", F.xxhash64("text").alias("_t"))
    picked = texts.join(F.broadcast(want) if small_enough(want) else want, ["_d", "_t"])
    memo: dict[bytes, int] = {}

    def run(cols):
        out = {"id": [], "n": [], "data": []}
        for i, t, digest in zip(cols["id"], cols["text"], cols["digest"]):
            s = shingles(t, words, memo)
            if _digest(s) == digest:
                out["id"].append(i)
                out["n"].append(len(s))
                out["data"].append(s.tobytes())
        return out

    return map_rows(picked, run, "id long, n long, data binary", ["id", "text", "digest"], chunk=64).dropDuplicates(["id"])


def _confirm(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union on the full sets."""
    pairs = stored(pairs, "likely")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = stored(_sets(docs, classes, ids, words), "sets")

    def test(na, a, nb, b):
        if 100 * min(na, nb) < percent * max(na, nb):
            return False
        x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        common = int((x[np.minimum(np.searchsorted(x, y), na - 1)] == y).sum())
        return 100 * common >= percent * (na + nb - common)

    return _meet(pairs, sets, test)


def _rooted(bands: DataFrame, roots: DataFrame) -> DataFrame:
    """``(band, id, root)`` with the component of each class so far."""
    return bands.join(roots, bands["id"] == roots["node"], "left").select(
        "band", "id", F.coalesce("root", "id").alias("root"))


def _open(rooted: DataFrame) -> DataFrame:
    """The rows of band keys whose classes lie in several components."""
    mixed = (rooted.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .where("lo <> hi").select("band"))
    return rooted.join(mixed, "band", "left_semi")


def _shared(rows: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """``rows`` with ``n``, the sketch's bit planes, and ``c``, the number of the class's shingles that some
    other class of ``rows`` has. A pair shares at most the smaller ``c``; classes
    whose ``c`` can't reach the limit with any partner are left out."""
    ids = stored(rows.select("id").distinct(), "ids")
    sets = stored(_sets(docs, classes, ids, words), "sets")
    own = (map_rows(sets, _each_shingle, "id long, s long", ["id", "data"], chunk=64).groupBy("s").agg(F.count("*").alias("k"), F.min("id").alias("id")).where("k = 1")
           .groupBy("id").agg(F.count("*").alias("own")))
    c = (sets.join(classes.select("id", "registers"), "id").join(own, "id", "left")
         .select("id", "n", "registers", "data", (F.col("n") - F.coalesce("own", F.lit(0))).alias("c"))
         .where(100 * F.col("c") >= percent * F.col("n")))

    def run(cols):
        made = [marks(np.frombuffer(d, np.uint64)) for d in cols["data"]]
        return {"id": cols["id"], "n": cols["n"], "c": cols["c"], "lost": [m[1] for m in made], "marks": [m[0] for m in made],
                "bits": [planes(np.frombuffer(r, np.uint16)) for r in cols["registers"]]}

    c = map_rows(c, run, "id long, n long, c long, lost long, marks array<long>, bits array<long>", ["id", "n", "c", "data", "registers"])
    return rows.join(c, "id").select("band", "root", *OWN)


def _each_shingle(cols):
    sets = [np.frombuffer(d, np.int64) for d in cols["data"]]
    return {"id": np.repeat(np.array(cols["id"], np.int64), [len(s) for s in sets]),
            "s": np.concatenate(sets) if sets else np.empty(0, np.int64)}


OWN = ["id", "n", "c", "lost", "marks", "bits"]


def _candidates(rest: DataFrame, percent: int, limit: float) -> tuple[DataFrame, DataFrame]:
    """The leaders of a round and the pairs that they form. A band key's members are cut into
    parts of about ``PART`` rows, each with a copy of the key's leaders."""
    usual = (rest.groupBy("band", "root").agg(F.count("*").alias("k")).groupBy("band")
             .agg(F.max(F.struct("k", "root")).alias("r"), F.sum("k").alias("m"))
             .select("band", F.col("r.root").alias("usual"), F.ceil(F.col("m") / PART).alias("parts")))
    rest = rest.join(usual, "band")
    rank = Window.partitionBy("band").orderBy("id")
    lead = stored(rest.where("root <> usual").withColumn("at", F.row_number().over(rank))
                  .where(F.col("at") <= LEADERS)
                  .select("band", "parts", "root", *OWN), "leads")
    each = (lead.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
            .select("band", "part", F.lit(True).alias("leads"), "root", *OWN))
    members = rest.select("band", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"), F.lit(False).alias("leads"), "root", *OWN)
    schema = "a long, b long"
    arrow = arrow_schema(rest.sparkSession, schema)
    most = most_differing(limit)

    def run(batches):
        key, held = None, []
        for batch in batches:
            keys = list(zip(batch.column("band").to_pylist(), batch.column("part").to_pylist()))
            leads = batch.column("leads").to_pylist()
            out, i = [], 0
            while i < len(keys):
                end = i
                while end < len(keys) and keys[end] == keys[i] and leads[end] == leads[i]:
                    end += 1
                rows = _side(batch.slice(i, end - i))
                if leads[i]:
                    held = [rows] if keys[i] != key else [*held, rows]
                    key = keys[i]
                elif keys[i] == key:
                    for some in held:
                        out.extend(_fitting(some, k, rows, percent, most) for k in range(len(some["id"])))
                i = end
            a, b = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=arrow)

    pairs = (each.union(members).repartition("band", "part").sortWithinPartitions("band", "part", F.desc("leads"))
             .mapInArrow(run, schema).distinct())
    return lead.select("band", "id"), pairs


def _side(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Columns of leaders or members as arrays, the bits as a matrix."""
    out = {c: batch.column(c).to_numpy() for c in ("root", "id", "n", "c", "lost")}
    for c in ("marks", "bits"):
        out[c] = batch.column(c).flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)
    return out


def _fitting(leads: dict, k: int, rows: dict, percent: int, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Leader ``k`` with those of ``rows`` in other components whose bounds allow a link."""
    total = rows["n"] + leads["n"][k]
    shared = np.minimum(rows["c"], leads["c"][k])
    at = np.flatnonzero((rows["root"] != leads["root"][k]) & (100 * shared >= percent * (total - shared)))
    # No pair shares more than the marks that both set, and what either lost by setting one twice.
    marks = np.bitwise_count(rows["marks"][at] & leads["marks"][k]).sum(1, dtype=np.int64) + np.minimum(rows["lost"][at], leads["lost"][k])
    shared = np.minimum(shared[at], marks)
    at = at[100 * shared >= percent * (total[at] - shared)]
    odd = (rows["bits"][at] ^ leads["bits"][k]).reshape(len(at), PLANES, REPEATS * BUCKETS // 64)
    differing = np.bitwise_count(np.bitwise_or.reduce(odd, axis=1)).sum(1, dtype=np.int64)
    at = at[differing <= most]
    return np.full(len(at), leads["id"][k]), rows["id"][at]


def class_roots(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """``(node, root)`` of the classes that have a link, by their ``id``."""
    limit = percent / 100
    bands = _bands(classes)
    keys = bands.groupBy("band").agg(F.count("*").alias("m"), F.min("id").alias("lead")).where("m > 1")
    rows = stored(bands.join(keys.select("band", "lead"), "band"), "bands")
    pairs = stored(rows.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct(), "met")
    links = stored(_confirm(_likely(pairs, classes, limit), docs, classes, words, percent), "pairs")
    tested = [links]
    # Each first leader has met all classes of its key.
    roots = stored(components(links), "roots")
    rest = stored(_open(_rooted(rows.where("id <> lead").select("band", "id"), roots)), "rest")
    if rest.isEmpty():
        return roots
    rest = stored(_open(_shared(rest, docs, classes, words, percent)), "rest")
    sizes = stored(rest.select(*OWN).dropDuplicates(["id"]), "sizes")
    while not rest.isEmpty():
        lead, pairs = _candidates(rest, percent, limit)
        tested.append(stored(_confirm(_likely(stored(pairs, "met"), classes, limit), docs, classes, words, percent), "pairs"))
        rest = rest.join(lead, ["band", "id"], "left_anti").select("band", "id")
        if not tested[-1].isEmpty():
            roots = stored(components(_union(tested)), "roots")
        rest = stored(_open(_rooted(rest, roots)).join(sizes, "id").select("band", "root", *OWN), "rest")
    return roots


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def row_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``near_duplicates`` with ``tkey``, the hash that tells the texts of an id apart."""
    table = stored(sketch_table(docs, words), "sketches")
    first = table.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("doc_id", "tkey", "n", "registers")).alias("r")).select("digest", "r.*")
    # Numbered as written: unique whichever task or attempt writes a row, and fixed from then on.
    classes = stored(first.withColumn("id", F.monotonically_increasing_id()), "classes")
    roots = class_roots(docs, classes, words, percent)
    member = (classes.select("digest", "id", "doc_id").join(roots, F.col("id") == F.col("node"), "left")
              .select("digest", "doc_id", F.coalesce("root", "id").alias("root")))
    least = member.groupBy("root").agg(F.min("doc_id").alias("component"))
    member = member.join(least, "root").select("digest", "component")
    out = table.select("doc_id", "tkey", "n", "digest").join(member, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "tkey", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs(doc_id, text)``;
    ``component_id`` is the smallest id reachable over links with
    100 * intersection >= percent * union."""
    return row_components(docs, words, percent).drop("tkey")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without the near duplicates of a smaller id, columns unchanged. Rows
    that repeat id and text stay once; of an id with several texts those go that
    are duplicates; rows with a null id stay."""
    near = stored(row_components(docs, words, percent).where("doc_id IS NOT NULL")
                  .groupBy("doc_id", "tkey").agg(F.max("kept").alias("kept"), F.count("*").alias("rows")), "kept")
    name = "_" + "_".join(docs.columns)  # longer than any column's name
    keyed = docs.withColumn(name, F.struct(F.col("doc_id").alias("d"), F.xxhash64("text").alias("t")))
    key = F.struct(F.col("doc_id").alias("d"), F.col("tkey").alias("t")).alias(name)
    drop = near.where("NOT kept").select(key)
    out = keyed.join(F.broadcast(drop) if small_enough(drop) else drop, name, "left_anti")
    many = near.where("kept AND rows > 1").select(key)
    if many.isEmpty():
        return out.select(*docs.columns)
    side = F.broadcast(many) if small_enough(many) else many
    repeated = out.join(side, name, "left_semi").dropDuplicates([name])
    return out.join(side, name, "left_anti").select(*docs.columns).union(repeated.select(*docs.columns))
