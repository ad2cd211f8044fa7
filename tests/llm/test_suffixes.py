"""Suffix-array decontamination against window matching by dictionary."""

import hashlib
import random
import re

import pytest

import __spark_entry__ as entry
from llm_helpers import SF_SMALL, make_docs  # noqa: F401
from windshear.llm import suffixes as sx

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    windows = {}
    for name, text in items:
        ws = split(text)
        n = min(size, len(ws))
        for i in range(len(ws) - n + 1 if ws else 0):
            windows.setdefault(tuple(ws[i:i + n]), set()).add(name)
    out = []
    for doc_id, text in docs:
        ws, hit, names = split(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(ws) - n + 1):
                found = windows.get(tuple(ws[i:i + n]))
                if found:
                    hit.update(range(i, i + n))
                    names |= found
        out.append((doc_id, len(ws), len(hit), tuple(sorted(str(x) for x in names if x is not None))))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in df.collect()), key=str)


def case(seed=5):
    rnd = random.Random(seed)
    text = lambda n: " ".join(rnd.choices(["a", "b", "C", "é-x", "9"], k=n))
    items = [(k, text(rnd.choice([1, 2, 9, 10, 14, 40]))) for k in range(25)] + [(99, None), (98, ""), (None, text(12)), (3, "b b")]
    docs = [(k, text(rnd.choice([0, 1, 8, 30, 400]))) for k in range(40)] + [(50, None), (50, None), (51, items[3][1]), (None, items[4][1])]
    return docs, items


def test_equal_to_brute_force(spark, make_docs):
    docs, items = case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (3, 10):
        assert rows(sx.contamination(make_docs(docs), bench, size)) == brute(docs, items, size)


def test_chunks_of_the_benchmark_give_the_same(spark, make_docs, monkeypatch):
    docs, items = case(6)
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(sx, "CHUNK_WORDS", 60)
    assert rows(sx.contamination(make_docs(docs), bench, 10)) == brute(docs, items, 10)
    kept = sx.keep_uncontaminated(make_docs(docs), bench, 10)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d[0]) for d in brute(docs, items, 10) if not d[2])


def test_longest_match(spark, make_docs):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve")], "item_id long, text string")
    docs = make_docs([(1, "x two three four five y three four"), (2, "nothing here")])
    got = {r["doc_id"]: (r["longest"], r["longest_at"], r["longest_item"], r["n_hit"]) for r in sx.contamination(docs, bench).collect()}
    assert got == {1: (4, 1, "1", 0), 2: (0, -1, None, 0)}


@pytest.mark.parametrize("empty", ["docs", "bench"])
def test_empty_tables(spark, make_docs, empty):
    docs = make_docs([] if empty == "docs" else [(1, "a b c")])
    bench = spark.createDataFrame([] if empty == "bench" else [(1, "a b c")], "item_id long, text string")
    assert [r["n_hit"] for r in sx.contamination(docs, bench).collect()] == ([] if empty == "docs" else [0])


def test_query_equals_brute_force(spark):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/{t}.parquet").select(*c).collect()]
    want = brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    got = entry.queries()["op10_suffix_arrays"](spark, SF_SMALL).collect()
    digest = lambda names: hashlib.sha256(",".join(names).encode()).hexdigest()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got), key=str) == sorted(
        ((d, n, h, len(i), digest(i), h > 0) for d, n, h, i in want), key=str)


@pytest.mark.parametrize("items", [[], [(1, None)], [(1, "")], [(1, "one two three " * 9)]])
@pytest.mark.parametrize("limit", [sx.CHUNK_WORDS, 3])
def test_empty_benchmarks_and_chunks_match_nothing(spark, make_docs, monkeypatch, items, limit):
    """With the small limit most of the nine chunks of a single long item are empty."""
    monkeypatch.setattr(sx, "CHUNK_WORDS", limit)
    docs = [(1, "four five six"), (1, "four five six"), (2, None), (None, items[0][1] if items else "x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows(sx.contamination(make_docs(docs), bench)) == brute(docs, items)
    left = sorted(str(r["doc_id"]) for r in sx.keep_uncontaminated(make_docs(docs), bench).collect())
    assert left == (["1", "1", "2"] if items and len(items[0][1] or "") > 9 else ["1", "1", "2", "None"])


def test_one_passage_in_many_items_and_documents_is_no_product():
    """800 items that hold the same 40 words, against 1,000 copies in one shard."""
    import time

    passage = [f"w{k}" for k in range(40)]
    p = sx.probe([(f"i{k}", " ".join([f"a{k}", *passage])) for k in range(800)], 10)
    docs = [[b"x", *(w.encode() for w in passage), f"z{k}".encode()] for k in range(1000)]
    began = time.time()
    got = sx.match_shard(docs, p)
    assert time.time() - began < 4
    assert all(hit == 40 and len(its) == 800 and best[0] == 40 and best[1] == 1 for hit, _, its, best in got)
