"""Plain spans against the patterns as written, disguises, and redaction."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from llm_helpers import SF_SMALL, make_docs  # noqa: F401
from windshear.llm import pii

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(d):
    v = [int(c) for c in d][::-1]
    return sum(v[::2] + [x * 2 - 9 * (x > 4) for x in v[1::2]]) % 10 == 0


def brute(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = (True, all(int(x) <= 255 for x in m.group().split(".")) if k == 1 else True, 12 <= len(d) <= 19 and luhn(d), 9 <= len(d) <= 15)[k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_plain_spans_equal_the_patterns():
    rnd = random.Random(2)
    for _ in range(4000):
        t = "".join(rnd.choices("aZ9 0.@+-() 14%_é", k=rnd.randrange(60)))
        assert pii.plain_spans(t) == brute(t), t
    t = "a 4111-1111-1111-1111, 10.0.0.256 1.2.3.4.5.6.7.8 x@y@z.de +1 (684) 555-8031."
    assert pii.plain_spans(t) == brute(t) and len(brute(t)) >= 4


@pytest.mark.parametrize("text,kind,found", [
    ("mail jane dot doe at mail dot example dot com today", "email", "jane dot doe at mail dot example dot com"),
    ("to jane [at] mail (dot) org!", "email", "jane [at] mail (dot) org"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("ｊｏｈｎ＠ｍａｉｌ．ｃｏｍ", "email", "ｊｏｈｎ＠ｍａｉｌ．ｃｏｍ"),
    ("call plus one six eight four five five five eight zero three one", "phone", "plus one six eight four five five five eight zero three one"),
    ("ip 192[.]168[.]1[.]7", "ip", "192[.]168[.]1[.]7"),
    ("card four one one one 1111 1111 1111 one", "card", None),
])
def test_disguises(text, kind, found):
    base, added = pii.spans(text)
    assert not base
    if found:
        assert [(pii.KINDS[k], text[s:e]) for s, k, e in added] == [(kind, found)]


def test_ordinary_prose_is_left_alone():
    for t in ("look at this, two of three were one. dot", "meet at example.com at five", "un deux", "née à Paris — voilà"):
        assert pii.spans(t) == ([], [])


def test_long_texts_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1" + " " * 200_000, "@" * 100_000, "one " * 50_000, "dot " * 50_000):
        pii.spans(t)


def test_find_and_redact(make_docs):
    docs = make_docs([(1, "x a@b.co y"), (2, None), (3, ""), (1, "x a@b.co y")]).withColumn("spans", F.lit("own"))
    got = sorted((r["doc_id"], r["n_email"], r["spans"]) for r in pii.find(docs).collect())
    assert got == [(1, 1, "email:2:8"), (1, 1, "email:2:8"), (2, 0, ""), (3, 0, "")]
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert {(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()} == {(1, "x [EMAIL] y", 11), (2, None, 0), (3, "", 0)}
    assert pii.find(make_docs([])).count() == 0


def test_query_against_brute_force(spark):
    docs = dict(tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    for r in entry.queries()["op4_deobfuscated_pii"](spark, SF_SMALL).collect():
        base = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in brute(docs[r["doc_id"]])]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r["spans"].split(","))


def found(text):
    return [(pii.KINDS[k], text[s:e]) for s, k, e in sorted(pii.spans(text)[0] + pii.spans(text)[1])]


@pytest.mark.parametrize("text, kind, whole", [
    ("write to jоhn@gmail.com now", "email", "jоhn@gmail.com"),
    ("write to jo​hn@gmail.com now", "email", "jo​hn@gmail.com"),
    ("mail john at gmail.com or", "email", "john at gmail.com"),
    ("mail john.doe2 at example.org or", "email", "john.doe2 at example.org"),
    ("ip one nine two dot one six eight dot one dot one end", "ip", "one nine two dot one six eight dot one dot one"),
    ("ip 10 dot 0 dot zero dot seven end", "ip", "10 dot 0 dot zero dot seven"),
    ("at john dot a dot b dot c dot d dot e at host dot com ok", "email", "john dot a dot b dot c dot d dot e at host dot com"),
    (f"x {'l' * 70} at {'h' * 80} dot org y", "email", f"{'l' * 70} at {'h' * 80} dot org"),
    ("x john     [at]      host     (dot)    org y", "email", "john     [at]      host     (dot)    org"),
    ("call plus four nine    one five one two three four five six seven eight now", "phone",
     "plus four nine    one five one two three four five six seven eight"),
])
def test_disguises_are_found_whole(text, kind, whole):
    assert (kind, whole) in found(text)
    assert pii.redacted(text) == text.replace(whole, f"[{kind.upper()}]")


@pytest.mark.parametrize("text", ["we met at noon. Then left", "look at 1.25 of it", "one dot two dot three", "at a.b", "point one two",
                                  "stood at leosrm.25 here", "one two", "the dot at the end"])
def test_plain_prose_stays(text):
    assert pii.spans(text) == ([], []) and pii.redacted(text) == text


def test_long_disguises_take_linear_time():
    import time

    began = time.time()
    for text in ("x dot " * 20_000, "a at " * 20_000, " " * 50_000 + "dot at", "one " * 20_000, "[at] " * 20_000,
                 "a@b.cc jo​e@b.cc " * 4_000, "1 dot " * 20_000, "one dot " * 20_000):
        pii.spans(text)
    assert time.time() - began < 20


def test_batches_are_handled_in_slices():
    """A task holds the texts of one slice beside the batch, not a second and a third copy of the whole batch."""
    import pyarrow as pa

    from windshear.llm import toxicity

    class Docs:
        columns, schema = ["doc_id", "text", "n_chars"], None
        sparkSession = type("S", (), {"sparkContext": type("C", (), {"broadcast": staticmethod(lambda v: type("B", (), {"value": v}))})})

        def select(self, *names):
            return self

        def mapInArrow(self, fn, schema):
            return fn

    texts = [None if i % 7 == 0 else f"{i} a@b.cd" for i in range(1300)]
    batch = pa.record_batch({"doc_id": list(range(1300)), "text": texts, "n_chars": [t and len(t) for t in texts]})
    out = list(pii.redact(Docs())(iter([batch, batch.slice(0, 0)])))
    assert max(b.num_rows for b in out) <= 512
    assert [x for b in out for x in b.column("text").to_pylist()] == [pii.redacted(t) for t in texts]
    assert [x for b in out for x in b.column("n_chars").to_pylist()] == [t and len(pii.redacted(t)) for t in texts]
    kept = list(toxicity.keep_clean(Docs(), toxicity.Model())(iter([batch])))
    assert max(b.num_rows for b in kept) <= 512 and sum(b.num_rows for b in kept) == 1300
