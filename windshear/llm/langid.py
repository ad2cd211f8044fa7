"""Language identification, words first.

A model holds, per language, the log frequency of every word seen at least
``LEAST_WORD`` times in the training sample, and of the character n-grams (lengths 5 to 1, word
edges marked) seen at least ``LEAST_GRAM`` times. A known word scores by its own log
frequencies. An unseen word backs off: from its start the longest known n-gram is
taken again and again, and the mean over these pieces stands for the word. The language
with the highest sum over the text's words wins (ties: the first by name); the score is
its share under a softmax of the mean word scores, sharpened by the number of
words up to ``SHARP``.

Training reads distinct texts with a language, never of held-out ids: the ``SAMPLE_ROWS`` with the smallest
hashes, and of each language all up to ``LANGUAGE_ROWS``, else about as many, by the same hash, so
that rare languages are learned. A text that stands n times counts 1 + log2(n) times. The id,
language and source of a document are not inputs of its prediction.

The model holds only the languages that an item was seen in, so that it grows with the sample and not
with items x languages; its scores are computed in Spark.

Defined cases: null text and text without letters (numerals such as a half or a Roman eight are none) give ``und`` with score 0; a row with null language
is not learned from; without any training row every text is ``und``; repeated rows are
predicted alike; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windshear.llm.common import held_out, map_rows, share, small_enough, stored

SAMPLE_ROWS, LANGUAGE_ROWS = 10_000, 1_000
LEAST_WORD, LEAST_GRAM, LONGEST = 3, 3, 5
SHARP = 20
HELD, HELD_SCORES = 50_000, 4_000_000
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
ASCII_WORD = re.compile("[a-z]+")


def words_of(text: str) -> list[str]:
    """Runs of letters with their marks, in lower case. Letters are those of Unicode's category L: numerals are none."""
    return (ASCII_WORD if text.isascii() else WORD).findall(text.lower())


@dataclass
class Model:
    """Log frequencies per item and language; the size is bounded by the training sample. Only the languages
    an item was seen in are held; the others share a value by the item's size (0 for words)."""
    langs: list[str]
    items: list[str]
    sizes: np.ndarray
    start: np.ndarray  # of an item's entries
    lang: np.ndarray
    score: np.ndarray
    unseen: np.ndarray  # size x language

    def __post_init__(self):
        self.words, self.grams = {}, {}
        for i, (item, size) in enumerate(zip(self.items, self.sizes.tolist())):
            (self.grams if size else self.words)[item] = i
        self.memo: dict[str, int] = {}
        self.held = np.zeros((max(1000, min(HELD, HELD_SCORES // max(1, len(self.langs)))), len(self.langs)))

    def __reduce__(self):
        return Model, (self.langs, self.items, self.sizes, self.start, self.lang, self.score, self.unseen)

    def _dense(self, i: int) -> np.ndarray:
        out = self.unseen[self.sizes[i]].copy()
        out[self.lang[self.start[i]:self.start[i + 1]]] = self.score[self.start[i]:self.start[i + 1]]
        return out

    def word_scores(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return self._dense(known)
        total, pieces, at = np.zeros(len(self.langs)), 0, 0
        marked = f"<{word}>"
        while at < len(marked):
            for n in range(LONGEST, 0, -1):
                known = self.grams.get(marked[at:at + n])
                if known is not None:
                    total += self._dense(known)
                    break
            pieces += 1
            at += n
        return total / pieces

    def _row(self, word: str) -> int:
        if len(self.memo) == len(self.held):
            self.memo.clear()
        at = self.memo[word] = len(self.memo)
        self.held[at] = self.word_scores(word)
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words_of(text)) if text else None
        if not counts or not self.langs:
            return "und", 0.0
        total, n, found = np.zeros(len(self.langs)), 0, list(counts.items())
        for lo in range(0, len(found), 500):  # fewer than are held, so that no row is replaced while it is used
            part = found[lo:lo + 500]
            if len(self.memo) + len(part) > len(self.held):
                self.memo.clear()
            rows = [self.memo[w] if w in self.memo else self._row(w) for w, _ in part]
            weights = np.array([c for _, c in part], float)
            n += int(weights.sum())
            total += weights @ self.held[rows]
        best = int(total.argmax())
        sharp = min(n, SHARP) / n
        return self.langs[best], float(1 / np.exp(np.maximum(-700.0, (total - total[best]) * sharp)).sum())


def _word_counts(cols):
    words = Counter()
    for text, lang, weight in zip(cols["text"], cols["lang"], cols["weight"]):
        for w in words_of(text):
            words[w, lang] += weight
    return {"item": [k[0] for k in words], "lang": [k[1] for k in words], "n": list(words.values())}


def _gram_counts(cols):
    grams = Counter()
    for word, lang, n in zip(cols["item"], cols["lang"], cols["n"]):
        w = f"<{word}>"
        for i in range(len(w)):
            for k in range(1, min(LONGEST, len(w) - i) + 1):
                grams[w[i:i + k], lang] += n
    return {"item": [k[0] for k in grams], "lang": [k[1] for k in grams], "n": list(grams.values())}


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, each: int = LANGUAGE_ROWS) -> DataFrame:
    """``(text, lang, weight)``: the training texts, each once per language."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    usable = usable.select("doc_id", "text", "lang", F.xxhash64("text").alias("h"))
    # Hashes first, so that no text is sorted.
    texts = stored(usable.groupBy("h", "lang").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")), "texts")
    sizes = texts.groupBy("lang").agg(F.count("*").alias("texts"))
    if small_enough(sizes):
        sizes = F.broadcast(sizes)
    place = F.col("h") / F.lit(2.0 ** 64) + 0.5  # of the hash in 0..1
    rare = texts.join(sizes, "lang").where((F.col("texts") <= each) | (place < each / F.col("texts"))).select(*texts.columns)
    picked = rare.union(texts.orderBy("h", "lang").limit(rows)).distinct()
    picked = stored(picked.withColumn("weight", F.floor(1 + F.log2("n")).cast("long")).drop("n"), "picked")
    side = F.broadcast(picked) if small_enough(picked) else picked
    return usable.join(side, ["h", "lang", "doc_id"]).dropDuplicates(["h", "lang"]).select("text", "lang", "weight")


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """The model of a bounded sample. Spark counts and scores; the driver receives each kept item once,
    with the languages it was seen in, as Arrow columns."""
    schema = "item string, lang string, n long"
    by_item = lambda df: df.groupBy("item", "lang").agg(F.sum("n").alias("n"))
    word_counts = stored(by_item(map_rows(sample(docs, rows), _word_counts, schema, ["text", "lang", "weight"], chunk=1024)), "words")
    gram_counts = by_item(map_rows(word_counts, _gram_counts, schema, ["item", "lang", "n"], chunk=8192))

    def kept(counts: DataFrame, least: int, size) -> DataFrame:
        each = counts.groupBy("item").agg(F.sum("n").alias("all"), F.collect_list(F.struct("lang", "n")).alias("by"))
        return each.where(F.col("all") >= least).select("item", size.alias("size"), "by")

    items = stored(kept(word_counts, LEAST_WORD, F.lit(0)).union(kept(gram_counts, LEAST_GRAM, F.char_length("item"))), "items")
    pairs = items.select("item", "size", F.explode("by").alias("x")).select("item", "size", "x.*")
    totals = {(r["size"], r["lang"]): r["n"] for r in pairs.groupBy("size", "lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted({g for _, g in totals})
    unseen = np.array([[math.log(0.5 / (totals.get((size, g), 0) + 1.0)) for g in langs] for size in range(LONGEST + 1)]).round(4)
    unseen = unseen.reshape(LONGEST + 1, len(langs))
    if not langs:
        return Model([], [], *(np.empty(0, np.int64),) * 4, unseen)
    # One row for each size and language.
    side = docs.sparkSession.createDataFrame([(s, g, langs.index(g), float(n)) for (s, g), n in totals.items()],
                                             "size int, lang string, k int, total double")
    scored = pairs.join(F.broadcast(side), ["size", "lang"]).withColumn("s", F.round(F.log((F.col("n") + 0.5) / (F.col("total") + 1.0)), 4))
    table = (scored.groupBy("size", "item").agg(F.collect_list(F.struct("k", "s")).alias("x"))
             .select("item", "size", F.col("x.k").alias("k"), F.col("x.s").alias("s")).toArrow().combine_chunks())
    lists = table.column("k").combine_chunks()
    lists = lists.chunk(0) if hasattr(lists, "chunk") else lists
    scores = table.column("s").combine_chunks()
    scores = scores.chunk(0) if hasattr(scores, "chunk") else scores
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    return Model(langs, table.column("item").to_pylist(), table.column("size").to_numpy(), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
                 lists.flatten().to_numpy(), scores.flatten().to_numpy().astype(np.float32), unseen)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row of ``docs(doc_id, text)``."""
    get = share(docs.sparkSession, model)

    def run(cols):
        model = get()
        got = [model.predict(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

    return map_rows(docs, run, "doc_id long, lang_pred string, score double", ["doc_id", "text"])
