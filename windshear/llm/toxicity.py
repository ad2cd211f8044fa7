"""Toxic passages by maximum-scoring segments.

1. Token scores. Labelled documents are split into words; each word stands for
   itself and for its prefixes of 4, 5 and 6 letters (inflected forms of a known
   word). Per feature, the log-odds ratio of its document frequency in toxic
   against other documents is taken under an informative Dirichlet prior (the
   feature's own overall rate, ``PRIOR`` pseudo-documents). The score is the
   ratio moved ``SIGMAS`` standard deviations towards 0; features left below ``LEAST_SCORE`` are
   dropped, and copies of a text count once. A word scores by its strongest kept feature, but not
   where it stood ``REPEATS`` times in the ``NEARBY`` words before (runs of one word are no added
   evidence). Farther occurrences do not matter: each passage is scored on its own words.
2. Segments. Scores less ``DRIFT`` per word have a negative mean, so that the
   linear-time scan of Ruzzo and Tompa yields every maximal-scoring passage.
3. Calibration. For clean calibration documents ``lambda`` solves
   E[exp(lambda * s)] = 1 over their word scores. K is not fitted: it is the share of
   them with any positive segment, within 1e-4..1, giving each passage an expected number of chance occurrences
   E = K * n * exp(-lambda * S) (Karlin-Altschul) and a p-value 1 - exp(-E). A
   document's evidence is the sum of -ln p over its significant passages
   (E < ``MAX_E``); a logistic fit over a histogram of that evidence on the
   calibration rows turns it into a probability.

Training reads at most ``SAMPLE_ROWS`` labelled rows, those with the smallest
hashed ids; three quarters of these give the token scores, the rest the
calibration. Everything else covers all rows. Labels, language, source and id
are never inputs of a score.

Defined cases: null or empty text scores as a text without words (the base
probability); rows with a null label are not used; repeated rows are scored
alike; with no toxic or no clean labelled row the model is empty and every
document gets the base rate (0 without labels). Extra input columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windshear.llm.common import held_out, map_rows, share, sliced

SAMPLE_ROWS = 20_000
PREFIXES = (6, 5, 4)
PRIOR = 20.0
SIGMAS = 2.0
LEAST_SCORE = 1.2
LEAST_DOCS = 5
REPEATS = 2
NEARBY = 10
DRIFT = 0.25
MAX_E = 1.0
WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """The word and its shorter prefixes, most specific first."""
    return [word] + [word[:k] + "*" for k in PREFIXES if len(word) > k]


def log_odds(toxic: float, clean: float, n_toxic: float, n_clean: float) -> float:
    """Dirichlet-prior log-odds ratio, moved SIGMAS deviations towards zero."""
    rate = (toxic + clean) / (n_toxic + n_clean)
    a, a0 = PRIOR * rate, PRIOR
    up = math.log((toxic + a) / (n_toxic + a0 - toxic - a)) if n_toxic + a0 > toxic + a else 8.0
    down = math.log((clean + a) / (n_clean + a0 - clean - a)) if n_clean + a0 > clean + a else 8.0
    sure = SIGMAS * math.sqrt(1 / (toxic + a) + 1 / (clean + a))
    ratio = up - down
    return math.copysign(max(0.0, abs(ratio) - sure), ratio)


def maximal_segments(scores: list[tuple[int, float]], n: int, drift: float) -> list[tuple[int, int, float]]:
    """Ruzzo-Tompa: every maximal-scoring segment ``(start, end, score)`` of a
    sequence of ``n`` items that score ``-drift`` but for the listed positions."""
    found: list[list] = []  # start, end, total before the start, total at the end
    total, at = 0.0, 0
    for pos, s in scores:
        total -= drift * (pos - at)
        before, total, at = total, total + s, pos + 1
        if s <= 0:
            continue
        new = [pos, pos + 1, before, total]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j -= 1
            if j < 0 or found[j][3] >= new[3]:
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
    return [(a, b, hi - lo) for a, b, lo, hi in found]


@dataclass
class Model:
    """Token scores and calibration; its size is bounded by the training sample."""
    scores: dict[str, float] = field(default_factory=dict)
    lam: float = 1.0
    k: float = 1.0
    intercept: float = -30.0
    slope: float = 0.0

    def word_score(self, word: str) -> float:
        return max((self.scores.get(f, 0.0) for f in features(word)), key=abs)

    def e_value(self, s: float, n: int) -> float:
        return self.k * max(n, 1) * math.exp(-self.lam * s)

    def evidence(self, text: str | None, memo: dict[str, float]) -> tuple[float, list[tuple[int, int, float]], int, float]:
        """Evidence, segments (word positions), number of words, best segment score."""
        words = WORD.findall(text.lower()) if text else []
        hits, seen = [], {}
        for i, w in enumerate(words):
            s = memo.get(w)
            if s is None:
                s = self.word_score(w)
                if len(memo) > 50_000:
                    memo.clear()
                memo[w] = s
            if s:
                last = seen.setdefault(w, deque(maxlen=REPEATS))
                if len(last) < REPEATS or i - last[0] > NEARBY:
                    hits.append((i, s - DRIFT))
                last.append(i)
        segs = maximal_segments(hits, len(words), DRIFT) if hits else []
        total, best = 0.0, 0.0
        for _, _, s in segs:
            best = max(best, s)
            e = self.e_value(s, len(words))
            if e < MAX_E:
                total -= math.log(max(-math.expm1(-e), 1e-300))
        return total, segs, len(words), best

    def probability(self, evidence: float) -> float:
        z = self.intercept + self.slope * min(evidence, 200.0)
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled, not held-out rows, by the smallest hashed ids:
    ``(text, toxic, fold)``; fold 0 calibrates, 1-3 score tokens."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    known = known.where(~held_out("doc_id")).withColumn("_h", F.xxhash64("doc_id"))
    picked = known.orderBy("_h", "doc_id").limit(rows)
    return (docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(picked), "doc_id")
            .select("text", F.col("toxic").cast("int").alias("toxic"), F.pmod("_h", F.lit(4)).cast("int").alias("fold")))


def _feature_rows(cols):
    out = {"toxic": [], "feature": []}
    for text, toxic in zip(cols["text"], cols["toxic"]):
        fs = {f for w in set(WORD.findall(text.lower())) for f in features(w)}
        out["feature"].extend(fs)
        out["toxic"].extend([toxic] * len(fs))
    return out


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    data = sample(docs, labels, rows).dropDuplicates(["text"]).cache()
    try:
        sizes = {(r["toxic"], r["c"]): r["n"] for r in data.groupBy(
            "toxic", (F.col("fold") == 0).alias("c")).agg(F.count("*").alias("n")).collect()}
        n1, n0 = sizes.get((1, False), 0), sizes.get((0, False), 0)
        all1 = n1 + sizes.get((1, True), 0)
        base = all1 / max(1, sum(sizes.values()))
        model = Model(intercept=math.log(max(base, 1e-12) / max(1 - base, 1e-12)))
        if not n1 or not n0:
            return model
        counts = (map_rows(data.where("fold <> 0"), _feature_rows, "feature string, toxic int", ["text", "toxic"])
                  .groupBy("feature").agg(F.sum("toxic").alias("y1"), F.sum(1 - F.col("toxic")).alias("y0")))
        # Only features whose shrunken ratio can differ from 0 leave the executors; all stem from the sample.
        counts = counts.where((F.col("y1") + F.col("y0") >= LEAST_DOCS) & (
            F.abs(F.log((F.col("y1") + 0.01) / n1) - F.log((F.col("y0") + 0.01) / n0)) > 0.2))
        for r in counts.collect():
            s = log_odds(r["y1"], r["y0"], n1, n0)
            if abs(s) >= LEAST_SCORE:
                model.scores[r["feature"]] = round(max(-2.0, min(8.0, s)), 6)
        _calibrate(model, data.where("fold = 0"))
        return model
    finally:
        data.unpersist()


def _calibrate(model: Model, data: DataFrame) -> None:
    """Gumbel parameters from the clean calibration rows, then the logistic fit.
    Only histograms over rounded values come to the driver."""
    get = share(data.sparkSession, model)

    def words(cols):
        out = {"s": []}
        m = get()
        for text in cols["text"]:
            out["s"].extend(round(m.word_score(w), 1) for w in WORD.findall(text.lower()))
        return out

    hist = map_rows(data.where("toxic = 0"), words, "s double", ["text"]).groupBy("s").count().collect()
    s = np.array([r["s"] for r in hist]) - DRIFT
    p = np.array([r["count"] for r in hist], float)
    if len(s) and p.sum():
        p /= p.sum()
        lo, hi = 1e-3, 10.0  # the positive root of E[exp(lambda s)] = 1, where the mean is negative
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if float((p * np.exp(mid * s)).sum()) < 1 else (lo, mid)
        model.lam = min(max(lo, 0.05), 3.0)
    get = share(data.sparkSession, model)

    def best(cols):
        memo: dict[str, float] = {}
        got = [get().evidence(t, memo) for t in cols["text"]]
        return {"toxic": cols["toxic"], "best": [round(g[3], 1) for g in got]}

    rows = (map_rows(data, best, "toxic int, best double", ["text", "toxic"])
            .where("toxic = 0").agg(F.count("*"), F.sum((F.col("best") > 0).cast("int"))).first())
    # P(S > x) is about K n exp(-lambda x); K simplified, see the module's text.
    model.k = min(1.0, max(1e-4, (rows[1] + 1) / (rows[0] + 1))) if rows[0] else 1.0
    get = share(data.sparkSession, model)

    def evidence(cols):
        memo: dict[str, float] = {}
        return {"toxic": cols["toxic"], "e": [round(min(get().evidence(t, memo)[0], 200.0), 1) for t in cols["text"]]}

    hist = map_rows(data, evidence, "toxic int, e double", ["text", "toxic"]).groupBy("e", "toxic").count().collect()
    _logistic(model, hist)


def _logistic(model: Model, hist) -> None:
    """Newton iterations for a ridge-penalised logistic curve over binned evidence."""
    x = np.array([min(r["e"], 200.0) for r in hist])
    y = np.array([r["toxic"] for r in hist], float)
    w = np.array([r["count"] for r in hist], float)
    if not len(x) or y.min() == y.max():
        return
    X = np.stack([np.ones_like(x), x], 1)
    beta = np.array([model.intercept, 0.5])
    ridge = np.diag([1e-3, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ beta, -30, 30)))
        grad = X.T @ (w * (y - p)) - ridge @ beta
        hess = (X * (w * p * (1 - p) + 1e-9)[:, None]).T @ X + ridge
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    model.intercept, model.slope = float(beta[0]), max(0.0, float(beta[1]))


SCORED = "doc_id long, score double, n_words long, segments string"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, n_words, segments)`` for every row; ``segments`` lists the
    significant passages as ``first:end:E`` word positions."""
    get = share(docs.sparkSession, model)
    memo: dict[str, float] = {}

    def run(cols):
        m = get()
        out = {"doc_id": cols["doc_id"], "score": [], "n_words": [], "segments": []}
        for t in cols["text"]:
            e, segs, n, _ = m.evidence(t, memo)
            out["score"].append(m.probability(e))
            out["n_words"].append(n)
            out["segments"].append(",".join(f"{a}:{b}:{m.e_value(s, n):.3g}" for a, b, s in segs if m.e_value(s, n) < MAX_E))
        return out

    return map_rows(docs, run, SCORED, ["doc_id", "text"])


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, columns unchanged."""
    get = share(docs.sparkSession, model)
    memo: dict[str, float] = {}

    def run(batches):
        m = get()
        for batch in sliced(batches):
            keep = [m.probability(m.evidence(t, memo)[0]) < threshold for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
