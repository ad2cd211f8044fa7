"""HyperMinHash components against brute force over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from llm_helpers import SF_SMALL, make_docs  # noqa: F401
from windshear.llm import hyperminhash as hm
from windshear.llm.components import components


def brute(rows, percent, words=5):
    memo = {}
    sets = [(i, set(hm.shingles(t, words, memo).tolist())) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for i, s in sets:
        for x in s:
            where.setdefault(x, []).append(i)
    by = dict(sets)
    for i, s in sets:
        for j in {j for x in s for j in where[x] if j < i}:
            c = len(s & by[j])
            if 100 * c >= percent * len(s | by[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def texts(seed=3):
    """A large group of near copies of differing distance, exact copies, and unrelated texts that share a passage."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdefgh", k=5))
    base = [word() for _ in range(150)]
    rows = []
    for k in range(120):
        t = list(base)
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 6])):
            t[rnd.randrange(len(t))] = word()
        rows.append(" ".join(t))
    shared = " ".join(word() for _ in range(60))
    rows += [shared + " " + " ".join(word() for _ in range(rnd.choice([5, 8, 60]))) for _ in range(60)]
    rows += [" ".join(word() for _ in range(rnd.choice([1, 4, 5, 30]))) for _ in range(40)]
    rows += rows[:30] + ["one two", "ONE  Two\n", "", "   ", None]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("percent", [80, 85])
def test_components_equal_brute_force(make_docs, percent):
    rows = texts()
    got = hm.near_duplicates(make_docs(rows), 5, percent)
    assert result(got) == brute(rows, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.collect())


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert result(entry.queries()["op6_hyperminhash"](spark, SF_SMALL)) == brute(rows, 85)


def test_defined_cases(make_docs):
    assert hm.near_duplicates(make_docs([]), 5, 80).count() == 0
    got = hm.near_duplicates(make_docs([(1, None), (2, ""), (None, "a b c d e f"), (4, "a b c d e f")]), 5, 80).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} >= {(1, 0, 1), (2, 0, 2), (4, 2, 4)}


def test_keep_one_keeps_columns_and_smallest_id(make_docs):
    docs = make_docs([(3, "a b c d e f g"), (1, "a b c d e f g"), (2, "x y"), (5, None), (2, "x y"), (None, "x y")]).withColumn("root", F.lit(1))
    got = hm.keep_one(docs, 5, 80)
    assert got.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in got.collect()) == ["1", "2", "5", "None"]


def test_estimate_is_close():
    rnd = np.random.default_rng(1)
    common, a, b = (rnd.integers(0, 2 ** 63, n, dtype=np.uint64) for n in (800, 100, 100))
    sa, sb = np.r_[common, a], np.r_[common, b]
    j, used = hm.estimate(hm.sketch(sa), hm.sketch(sb), len(sa), len(sb))
    assert used > 300 and abs(j - 0.8) < 0.08


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components(links.limit(0)).count() == 0


def test_an_id_with_several_texts_loses_no_link(make_docs):
    one, two = ([f"{c}{k}" for k in range(60)] for c in "ab")
    near = lambda t: " ".join(t[:-1] + ["other"])
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, near(one)), (3, near(two)), (4, "alone " * 9)]
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in hm.near_duplicates(make_docs(rows), 5, 80).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)]
    assert sorted(r["doc_id"] for r in hm.keep_one(make_docs(rows), 5, 80).collect()) == [1, 1, 4]
    # Of an id with several texts, only the duplicate goes.
    rows[2] = (0, near(one))
    kept = hm.keep_one(make_docs(rows), 5, 80).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([rows[2], rows[1], rows[4]])


def test_many_partners_are_dealt_in_chunks(make_docs, monkeypatch):
    monkeypatch.setattr(hm, "PARTNERS", 7)
    monkeypatch.setattr(hm, "PART", 5)
    monkeypatch.setattr(hm, "LEADERS", 60)
    rows = texts(9)
    assert result(hm.near_duplicates(make_docs(rows), 5, 85)) == brute(rows, 85)
