"""Hard negatives by maximum inner product search in cover trees.

1. Candidates. Components become ``floor(256 * x)``; all scores are integers. A candidate
   ``x`` is augmented by ``sqrt(M^2 - |x|^2)``, ``M`` the largest norm, so that all candidates
   lie on one sphere, where distances order them as inner products do, and a query, augmented
   by 0, keeps its inner products. Of equal vectors of one label only the smallest ids go on, as
   many as any answer can use.
2. Cells. Pivots, chosen farthest first from at most ``SAMPLE_ROWS`` rows of smallest hashed
   id, cut the candidates into at most ``CELLS`` cells (nearest pivot); every candidate is indexed, and
   each cell knows its exact covering radius, size and labels. A cell is dealt by hash into shards of
   about ``SHARD_ROWS`` rows.
3. Trees. A task builds the cover tree of a shard: level by level the covering distance
   shrinks by ``BASE``, a node's points are split into balls around points of it, and each node keeps the exact
   radius over its descendants. Balls of few points are gathered in leaves. Trees are written once.
4. Search. An ask has a vector, a label, a kind (same or other label) and a window ``[lo, hi]``
   of scores. ``<q, c> +- |q| r`` bounds the scores below a node with centre ``c`` and radius ``r``,
   so nodes outside the window, below the k-th score found so far, or of unfit labels are skipped. Blocks of
   asks descend together, a level at a time; leaves are verified exactly, best bound
   first in growing waves. Asks first visit the cell most likely to hold their answer; the k-th score there
   then rules out other cells before any row is sent to them.
5. Mining. First the positives of each anchor (same label, no window), then for each anchor
   and positive the window that the positive's score sets, over the other labels.

The asks of a cell are dealt in parts of about ``ASKS`` and each shard's tree travels once to each part, so
neither a large cell nor many asks for one meet in a task. The answers equal brute force whatever the data;
where vectors have no cluster structure the bounds skip little, and the work grows as rows x anchors.

Defined cases: rows with a null label, vector or component, or one that isn't finite, take no part,
nor do rows with a null id; of rows that share an id one counts (the smallest label, then vector); shorter
vectors count as padded with zeros; ties go to the smaller id; an anchor without positives, or with no row in
the window (always so at a negative positive score), gives no rows; an empty table gives none; extra columns are
ignored. Squared norms (in 1/256) beyond 2^52 raise an error: their scores would not be exact.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from windshear.llm.common import arrow_schema, share, shuffle_parts, stored

SAMPLE_ROWS = 4096
CELLS = 1024
SHARD_ROWS = 4096
ASKS = 4096
BLOCK = 256
LEAF = 32
BASE = 1.3
LARGEST = 2.0 ** 52


@dataclass
class Tree:
    """Points in leaf order and nodes in level order; children follow their parents."""
    points: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    centre: np.ndarray  # index of a point
    radius: np.ndarray
    parent: np.ndarray
    level: np.ndarray
    start: np.ndarray  # leaves: range of points; inner nodes: empty
    stop: np.ndarray
    low: np.ndarray  # smallest and largest label below
    high: np.ndarray


def _lift(points: np.ndarray, top: float) -> np.ndarray:
    """The points with their augmenting coordinate."""
    rest = np.sqrt(np.maximum(0.0, top - (points ** 2).sum(1)))
    return np.c_[points, rest]


def build_tree(points: np.ndarray, ids: np.ndarray, labels: np.ndarray, top: float) -> Tree:
    """The cover tree of a shard's points; ``top`` is the largest squared norm of all candidates."""
    x = _lift(points.astype(np.float64), top)
    slack = 1e-6 * (1 + top ** 0.5)  # for rounding in distances

    def distances(idx, c):
        return np.sqrt(np.maximum(0.0, 2 * top - 2 * (x[idx] @ x[c]))) + slack

    def split(idx, radius):
        """Balls of about ``radius`` and, of what is left over, buckets: (points, centre, covering radius)."""
        balls, loose, left = [], [], idx
        while len(left):
            d = distances(left, left[0])
            near = d <= radius + slack
            near[0] = True
            if near.sum() * 4 >= LEAF:
                balls.append((left[near], left[0], float(d[near].max())))
            else:
                loose.append(left[near])
            left = left[~near]
        rest = np.concatenate(loose) if loose else idx[:0]
        for at in range(0, len(rest), LEAF):
            part = rest[at:at + LEAF]
            balls.append((part, part[0], float(distances(part, part[0]).max())))
        return balls

    everything = np.arange(len(x))
    first = float(distances(everything, 0).max())
    rows, order, queue = [], [], [(everything, 0, first, -1, 0, first)]
    for at, (idx, c, r, parent, level, cover) in enumerate(iter(_growing(queue))):
        if len(idx) <= LEAF or cover <= 4 * slack:
            rows.append((c, r, parent, level, len(order), len(order) + len(idx)))
            order.extend(idx.tolist())
            continue
        rows.append((c, r, parent, level, 0, 0))
        cover = min(cover, r) / BASE
        while len(parts := split(idx, cover)) == 1 and cover > 4 * slack:
            cover /= BASE
        queue.extend((p, k, rad, at, level + 1, cover) for p, k, rad in parts)
    centre, radius, parent, level, start, stop = map(np.array, zip(*rows))
    order = np.array(order)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    labels = labels[order]
    low, high = np.full(len(rows), np.iinfo(np.int64).max), np.full(len(rows), np.iinfo(np.int64).min)
    for i in range(len(rows) - 1, -1, -1):
        if stop[i] > start[i]:
            low[i], high[i] = labels[start[i]:stop[i]].min(), labels[start[i]:stop[i]].max()
        if parent[i] >= 0:
            low[parent[i]], high[parent[i]] = min(low[i], low[parent[i]]), max(high[i], high[parent[i]])
    return Tree(points[order], ids[order], labels, place[centre], radius.astype(float), parent, level, start, stop, low, high)


def _growing(queue: list):
    """The items of a list that grows while it is read."""
    at = 0
    while at < len(queue):
        yield queue[at]
        queue[at] = None
        at += 1


@dataclass
class Asks:
    """A block of asks; unbounded windows are infinite."""
    vectors: np.ndarray
    owner: np.ndarray  # an id that is no answer
    label: np.ndarray
    same: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    bound: np.ndarray  # a score already reached k times

    def fit(self, score: np.ndarray, low: np.ndarray, high: np.ndarray, reach: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Which asks (rows) may have an answer below which nodes (columns)."""
        own = self.label[:, None]
        label = np.where(self.same[:, None], (low <= own) & (own <= high), (low != own) | (high != own))
        return label & (score + reach >= floor[:, None]) & (score - reach <= self.hi[:, None])


def search(tree: Tree, asks: Asks, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ask, id, score)`` of the best ``k`` answers of each ask in this tree, by score, then smaller id."""
    n = len(asks.vectors)
    q = asks.vectors.astype(np.float64)
    norm = np.sqrt((q ** 2).sum(1))
    points = np.asarray(tree.points, np.float64)
    floor = np.maximum(asks.lo, asks.bound)
    alive = np.zeros((n, len(tree.radius)), bool)
    upper = np.full((n, len(tree.radius)), -np.inf)
    for level in range(int(tree.level[-1]) + 1):
        nodes = np.flatnonzero(tree.level == level)
        if level:
            nodes = nodes[alive[:, tree.parent[nodes]].any(0)]
        score = q @ points[tree.centre[nodes]].T
        reach = norm[:, None] * tree.radius[nodes] + 1e-6 * (1 + np.abs(score))
        ok = asks.fit(score, tree.low[nodes], tree.high[nodes], reach, floor)
        alive[:, nodes] = ok & alive[:, tree.parent[nodes]] if level else ok
        upper[:, nodes] = np.minimum(score + reach, asks.hi[:, None])
    leaves = np.flatnonzero(tree.stop > tree.start)
    upper = np.where(alive[:, leaves], upper[:, leaves], -np.inf)
    rank = np.empty(upper.shape, np.int64)
    np.put_along_axis(rank, np.argsort(-upper, axis=1, kind="stable"), np.arange(len(leaves))[None, :], axis=1)
    found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    done, wave = 0, 4
    while done < len(leaves):
        want = (rank >= done) & (rank < done + wave) & (upper >= floor[:, None]) & np.isfinite(upper)
        done, wave = done + wave, wave * 4
        more = [_verify(tree, points, q, asks, want[:, at], leaves[at], floor) for at in np.flatnonzero(want.any(0))]
        found = best(*map(np.concatenate, zip(found, *more)), k)
        held = np.bincount(found[0], minlength=n)
        last = np.searchsorted(found[0], np.arange(n), side="right") - 1
        full = held >= k
        floor[full] = np.maximum(floor[full], found[2][last[full]])
    return found


def _verify(tree, points, q, asks, want, leaf, floor):
    """Exact scores of a leaf's points for the asks that want it."""
    rows = np.flatnonzero(want)
    a, b = tree.start[leaf], tree.stop[leaf]
    score = q[rows] @ points[a:b].T
    ids, labels = tree.ids[a:b], tree.labels[a:b]
    ok = (score >= floor[rows, None]) & (score <= asks.hi[rows, None]) & (ids[None, :] != asks.owner[rows, None])
    ok &= (labels[None, :] == asks.label[rows, None]) == asks.same[rows, None]
    i, j = np.nonzero(ok)
    return rows[i], ids[j], score[i, j]


def best(ask: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    """The first ``k`` of each ask by score, then smaller id; sorted by ask."""
    order = np.lexsort((ids, -score, ask))
    ask, ids, score = ask[order], ids[order], score[order]
    first = np.searchsorted(ask, ask)
    keep = np.arange(len(ask)) - first < k
    return ask[keep], ids[keep], score[keep]


@dataclass
class Index:
    """Written trees, and the directory of at most ``CELLS`` cells."""
    trees: DataFrame  # cell, part, tree
    cells: np.ndarray  # of those with rows: number, pivot, covering radius, smallest and largest label
    pivots: np.ndarray
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray
    parts: dict[int, int]  # number of shards


def prepare(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``(vec_id, label, q)`` of the rows that take part, one for each id; ``q`` is an array of whole numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    q = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    valid = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
    one = valid.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), q.alias("q"))
    return one.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q")


def packed(rows: DataFrame) -> tuple[DataFrame, int, float, int]:
    """The prepared rows with ``data``, their vectors padded to one length as 64-bit floats'
    whole numbers in 32 or 64 bits; the number of rows, largest squared norm and length."""
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    most = F.coalesce(F.array_max(F.transform("q", lambda x: F.abs(x.cast("double")))), F.lit(0.0))
    n, top, size, largest = rows.agg(F.count("*"), F.max(square), F.max(F.size("q")), F.max(most)).first()
    if n and top >= LARGEST:
        raise ValueError("the vectors' squared norms exceed 2^52 (in units of 1/256); their scores would not be exact")
    kind = "<i4" if not n or largest < 2 ** 31 else "<i8"
    schema = "vec_id long, label long, data binary"
    arrow = arrow_schema(rows.sparkSession, schema)
    size = max(1, size or 1)

    def run(batches):
        for batch in batches:
            out = []
            for v in batch.column("q"):
                own = np.zeros(size, kind)
                values = v.values.to_numpy(zero_copy_only=False)
                own[:len(values)] = values
                out.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary())], schema=arrow)

    return stored(rows.mapInArrow(run, schema), "vectors"), n, float(top or 0.0), kind


def _vectors(column, kind) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), -1)


def _pivots(candidates: DataFrame, n: int, top: float, kind: str) -> np.ndarray:
    """Farthest-first pivots from a bounded sample."""
    rows = (candidates.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("data").collect())
    pool = np.stack([np.frombuffer(r["data"], kind) for r in rows]).astype(np.float64)
    x = _lift(pool, top)
    take, near = [0], np.full(len(x), np.inf)
    while len(take) < min(CELLS, -(-n // SHARD_ROWS), len(x)):
        near = np.minimum(near, 2 * top - 2 * (x @ x[take[-1]]))
        take.append(int(near.argmax()))
    return pool[take]


def build_index(vectors: DataFrame, n: int, top: float, kind: str, answers: int) -> Index:
    """Index every vector; ``answers`` is the largest number of ids of one vector and label that an answer can use."""
    same = Window.partitionBy("label", "data").orderBy("vec_id")
    candidates = vectors.withColumn("_at", F.row_number().over(same)).where(F.col("_at") <= answers).drop("_at")
    spark = vectors.sparkSession
    pivots = _pivots(vectors, n, top, kind)
    get = share(spark, _lift(pivots, top))
    schema = "cell int, away double, vec_id long, label long, data binary"
    arrow = arrow_schema(spark, schema)

    def nearest(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _lift(_vectors(batch.column("data"), kind).astype(np.float64), top)
            d = np.maximum(0.0, 2 * top - 2 * (x @ get().T))
            cell = d.argmin(1)
            away = np.sqrt(d[np.arange(len(d)), cell]) + 1e-6 * (1 + top ** 0.5)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(away), *(
                batch.column(c) for c in ("vec_id", "label", "data"))], schema=arrow)

    dealt = stored(candidates.mapInArrow(nearest, schema), "cells")
    cells = {r["cell"]: r for r in dealt.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("away").alias("r"), F.min("label").alias("low"), F.max("label").alias("high")).collect()}
    take = sorted(cells)
    parts = {c: -(-cells[c]["n"] // SHARD_ROWS) for c in take}
    dealt = _with(dealt, parts, "parts").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).drop("parts")
    tree = "cell int, part int, tree binary"
    tree_arrow = arrow_schema(spark, tree)

    def build(table: pa.Table) -> pa.Table:
        made = build_tree(_vectors(table.column("data"), kind), table.column("vec_id").to_numpy(),
                          table.column("label").to_numpy(), top)
        return pa.Table.from_arrays([table.column("cell")[:1], table.column("part")[:1],
                                     pa.array([pickle.dumps(vars(made))], pa.binary())], schema=tree_arrow)

    total = sum(parts.values())
    trees = stored(dealt.repartition(_tasks(spark, total), "cell", "part").groupBy("cell", "part").applyInArrow(build, tree), "trees")
    radius, low, high = (np.array([cells[c][k] for c in take]) for k in ("r", "low", "high"))
    return Index(trees, np.array(take), pivots[take], radius, low, high, parts)


def _with(df: DataFrame, numbers: dict[int, int], name: str) -> DataFrame:
    """The rows of the cells in ``numbers`` (at most ``CELLS``), with their number."""
    side = df.sparkSession.createDataFrame(list(numbers.items()), f"cell int, {name} int")
    return df.join(F.broadcast(side), "cell")


def _tasks(spark, groups: int) -> int:
    """Partitions for that many groups: about one each, within what is sensible."""
    return min(20_000, max(shuffle_parts(spark), 2 * groups))


ASK = "anchor long, positive long, data binary, label long, same boolean, lo double, hi double, bound double"
HIT = "anchor long, positive long, vec_id long, score long"


def _asks(batch, kind) -> Asks:
    get = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "label", "same", "lo", "hi", "bound")}
    return Asks(_vectors(batch.column("data"), kind), get["anchor"], get["label"], get["same"].astype(bool),
                get["lo"], get["hi"], get["bound"])


def _route(asks: DataFrame, index: Index, kind: str, home: bool) -> DataFrame:
    """Each ask with the cells to visit: its home cell, or all others that its bounds don't rule out."""
    get = share(asks.sparkSession, (index.cells, index.pivots, index.radius, index.low, index.high))
    schema = f"{ASK}, cell int"
    arrow = arrow_schema(asks.sparkSession, schema)

    def run(batches):
        cells, pivots, radius, low, high = get()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                a = _asks(part, kind)
                q = a.vectors.astype(np.float64)
                score = q @ pivots.T
                reach = np.sqrt((q ** 2).sum(1))[:, None] * radius + 1e-6 * (1 + np.abs(score))
                first = np.where(np.isfinite(a.hi)[:, None], -np.abs(score - a.hi[:, None]), score).argmax(1)
                if home:
                    i, j = np.arange(len(q)), first
                else:
                    ok = a.fit(score, low, high, reach, np.maximum(a.lo, a.bound))
                    ok[np.arange(len(q)), first] = False
                    i, j = np.nonzero(ok)
                rows = part.take(pa.array(i))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cells[j].astype(np.int32))], schema=arrow)

    return asks.mapInArrow(run, schema)


def _visit(routed: DataFrame, index: Index, kind: str, k: int) -> DataFrame:
    """The best ``k`` answers of each routed ask in each shard of its cell."""
    spark = routed.sparkSession
    routed = stored(routed, "routed")
    loads = {r["cell"]: -(-r["n"] // ASKS) for r in routed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    if not loads:
        return spark.createDataFrame([], HIT)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    trees = _with(index.trees, loads, "waves").withColumn("wave", each("waves")).drop("waves")
    asks = _with(_with(routed, loads, "waves"), index.parts, "parts").withColumn(
        "wave", F.pmod(F.xxhash64("anchor"), F.col("waves")).cast("int")).withColumn("part", each("parts")).drop("waves", "parts")
    both = trees.unionByName(asks, allowMissingColumns=True)
    groups = sum(loads[c] * index.parts[c] for c in loads)
    arrow = arrow_schema(spark, HIT)

    def run(batches):
        tree, at = None, None
        for batch in batches:
            key = list(zip(*(batch.column(c).to_pylist() for c in ("cell", "part", "wave"))))
            blob = batch.column("tree")
            i = 0
            while i < len(key):
                if blob[i].is_valid:
                    tree, at = Tree(**pickle.loads(blob[i].as_py())), key[i]
                    tree.points = tree.points.astype(np.float64)
                    i += 1
                    continue
                end = i
                while end < len(key) and end - i < BLOCK and key[end] == key[i] and not blob[end].is_valid:
                    end += 1
                if key[i] != at:
                    raise RuntimeError("an ask met no tree")
                part = batch.slice(i, end - i)
                ask, ids, score = search(tree, _asks(part, kind), k)
                take = pa.array(ask)
                yield pa.RecordBatch.from_arrays([part.column("anchor").take(take), part.column("positive").take(take),
                                                  pa.array(ids), pa.array(score.astype(np.int64))], schema=arrow)
                i = end

    return (both.repartition(_tasks(spark, groups), "cell", "part", "wave")
            .sortWithinPartitions("cell", "part", "wave", F.col("tree").isNull(), "anchor", "positive").mapInArrow(run, HIT))


def _top(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def answer(asks: DataFrame, index: Index, kind: str, k: int) -> DataFrame:
    """``(anchor, positive, rank, vec_id, score)``: the best ``k`` answers of each ask."""
    asks = stored(asks, "asks")
    first = stored(_visit(_route(asks, index, kind, True), index, kind, k), "hits")
    if len(index.radius) == 1:
        return _top(first, k)
    reached = (_top(first, k).groupBy("anchor", "positive").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("s"))
               .where(F.col("n") == k))
    bounded = (asks.drop("bound").join(reached, ["anchor", "positive"], "left")
               .withColumn("bound", F.coalesce("s", F.lit(float("-inf")))).select(*asks.columns))
    rest = _visit(_route(bounded, index, kind, False), index, kind, k)
    return _top(first.unionByName(stored(rest, "hits")), k)


def mine(rows: DataFrame, anchors, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows(vec_id, label, embedding)``; ``anchors`` is a condition on ``vec_id``. An anchor's positives are its best
    ``positives`` other rows of its label; of the other labels' rows with
    low * p <= 100 * score <= high * p for a positive's score p the best ``negatives`` are returned."""
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    vectors, n, top, kind = packed(prepare(rows))
    if not n:
        return spark.createDataFrame([], schema)
    index = build_index(vectors, n, top, kind, max(positives + 1, negatives))
    base = vectors.where(anchors).select(F.col("vec_id").alias("anchor"), "data", "label")
    none = F.lit(float("-inf"))
    first = base.select("anchor", F.col("anchor").alias("positive"), "data", "label", F.lit(True).alias("same"),
                        none.alias("lo"), F.lit(float("inf")).alias("hi"), none.alias("bound"))
    found = stored(answer(first, index, kind, positives).select(
        "anchor", F.col("vec_id").alias("positive"), F.col("score").alias("p")), "positives")
    asks = (found.where("p >= 0").join(base, "anchor")
            .select("anchor", "positive", "data", "label", F.lit(False).alias("same"),
                    F.expr(f"CAST((p * {low} + 99) DIV 100 AS DOUBLE)").alias("lo"), F.expr(f"CAST((p * {high}) DIV 100 AS DOUBLE)").alias("hi"),
                    none.alias("bound")))
    out = answer(asks, index, kind, negatives)
    return out.join(found, ["anchor", "positive"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), F.col("p").alias("positive_score"), F.col("score").alias("negative_score"))
