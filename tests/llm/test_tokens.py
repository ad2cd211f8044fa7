"""The BPE transducer against the tokenizers library, and the token alignment against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from llm_helpers import SF_SMALL, make_docs  # noqa: F401
from windshear.llm import alignment as al
from windshear.llm import transducer as td

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
PARTS = ["a", "e", "t", "he", "A", "İ", "Σ", "é", "é", "́", "中", "文", "한", "하", "'", "s", "ll", "re", "!", "-", "<|endoftext|>",
         "<|", "|>", " ", "  ", "\n", "\t", "\x85", "\x1c", "　", "1", "२", "½", "😀", "‍", "ſ", "ǆ", "ͅ", "া", "ক", "</w>", "\x00", "﻿"]


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    return td.Vocabulary(P.path(request.param)), Tokenizer.from_file(P.path(request.param))


def test_encoding_equals_the_library_for_any_slicing(pair):
    v, library = pair
    rnd = random.Random(5)
    for k in range(1200):
        text = "".join(rnd.choices(PARTS, k=rnd.randrange(1, 60)))
        text = text.replace(" ", "") * 4 if k % 9 == 0 else text
        want = library.encode(text, add_special_tokens=False).ids
        for size in (5, 23, 10 ** 6):
            assert td.Encoder(v, size).encode(text) == want, (size, text)


def test_very_long_words_stream_in_constant_memory(pair, monkeypatch):
    v, library = pair
    monkeypatch.setattr(td, "STEP", 64)
    assert 1 < v.lookahead < 1000
    rnd = random.Random(2)
    for text in ("a" * 9000, "the" * 4000, "".join(rnd.choices("abcdehinst", k=20000)), "ha" * 3000 + "!" * 3000, "'" * 900 + "s" * 900, "中文" * 2000):
        assert td.Encoder(v, 500).encode(text) == library.encode(text, add_special_tokens=False).ids
    run = td.WordTransducer(v)
    most = 0
    for c in "the" * 3000:
        list(run.feed(c.encode()))
        most = max(most, len(run.held))
    assert most <= v.lookahead + td.STEP


def test_lookahead_decides_the_first_token():
    """On small random merge lists: the first token of a prefix of ``lookahead`` symbols is that of the whole."""
    rnd = random.Random(8)
    for _ in range(60):
        tokens, merges = ["a", "b", "c"], []
        while len(merges) < 12:
            a, b = rnd.randrange(len(tokens)), rnd.randrange(len(tokens))
            if tokens[a] + tokens[b] not in tokens and len(tokens[a] + tokens[b]) < 7:
                merges.append((a, b, len(tokens)))
                tokens.append(tokens[a] + tokens[b])
        v = td.Vocabulary.__new__(td.Vocabulary)
        v.rank = {(a, b): (r << 32) + n for r, (a, b, n) in enumerate(merges, 1)}
        need = td.sufficient_lookahead([len(t) for t in tokens], merges)
        for _ in range(60):
            word = [rnd.randrange(3) for _ in range(need + rnd.randrange(1, 90))]
            assert v.merge(word)[0] == v.merge(word[:need])[0]


def test_merging_long_and_short_is_alike(pair):
    v, _ = pair
    rnd = random.Random(3)
    for _ in range(200):
        word = [v.inner[b] for b in "".join(rnd.choices("thersang", k=rnd.randrange(2, 64))).encode()]
        filler = [v.inner[0]] * 80  # no merge crosses into it
        assert v.merge(word + filler)[:len(v.merge(word))] == v.merge(word)


def test_decoding_in_runs_equals_the_library(pair):
    v, library = pair
    rnd = random.Random(4)
    for _ in range(300):
        ids = [rnd.randrange(len(v.tokens)) for _ in range(rnd.randrange(0, 30))]
        d, out, at = td.Decoder(v), "", 0
        while at < len(ids):
            step = rnd.randrange(1, 5)
            out += d.feed(ids[at:at + step])
            at += step
        assert out + d.finish() == library.decode(ids, skip_special_tokens=False)


def test_unsupported_files_are_refused(tmp_path):
    import json

    with open(P.path(FILES[0]), encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"normalizer": {"type": "NFKC"}}, {"decoder": {"type": "WordPiece"}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        path = tmp_path / "t.json"
        path.write_text(json.dumps(spec | change))
        with pytest.raises(ValueError, match="support"):
            td.Vocabulary(str(path))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_query_equals_the_library(spark):
    library = Tokenizer.from_file(P.path(FILES[0]))
    want = {}
    for doc_id, text in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    got = {r[0]: tuple(r[1:]) for r in entry.queries()["op12_transducer_bpe"](spark, SF_SMALL).collect()}
    assert got == want


CASES = [(1, "One  two's <|endoftext|> three"), (2, None), (3, ""), (None, "x y"), (1, "One  two's <|endoftext|> three"), (4, " \n\t "),
         (5, "naïve 中文 😀 \x00 ▁ piece"), (6, "word " * 3000), (7, "nospace" * 2000), (8, "<s> <unk> </s> <0x41>")]


def test_bpe_defined_cases_and_round_trip(make_docs):
    docs = make_docs(CASES).withColumn("ids", F.lit("clash"))
    path = P.path(FILES[1])
    library = Tokenizer.from_file(path)
    got = sorted(map(str, (tuple(r) for r in td.code(docs, path).collect())))
    want = []
    for doc_id, text in CASES:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append(str((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))))
    assert got == sorted(want)
    back = td.decoded(td.token_ids(docs, path), path).collect()
    assert sorted(str(tuple(r)) for r in back) == sorted(str((i, t or "")) for i, t in CASES)
    assert td.code(docs.limit(0), path).count() == 0


def brute(rows):
    """The contract's columns, token by token."""
    a_tok, b_tok = Tokenizer.from_file(P.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a_tok.encode_special_tokens = True
    c = al.Codecs(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    aligned, docs_of = [], Counter()
    for doc_id, text in rows:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(c.a_bytes[i] for i in a) != whole or b"".join(c.b_bytes[i] for i in b) != whole:
            a, b = [], []
        spans = []
        for ids, own in ((a, c.a_bytes), (b, c.b_bytes)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(own[i]), i))
                at += len(own[i])
            spans.append(out)
        links, first = [], 0
        for lo, hi, i in spans[0]:
            while first < len(spans[1]) and spans[1][first][1] <= lo:
                first += 1
            k = first
            while k < len(spans[1]) and spans[1][k][0] < hi:
                links.append((i, spans[1][k][2]))
                k += 1
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, low = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for lo, hi, i in s if low < hi <= e) for s in spans) if len(a) < 500 else None)
            low = e
        digest = sha(";".join(groups)) if a and len(a) < 500 else None if a else ""
        docs_of.update(set(links))
        aligned.append((doc_id, len(a), len(b), len(groups), links, digest))
    top = {}
    for (i, _), n in docs_of.items():
        top[i] = max(top.get(i, 0), n)
    return [(d, na, nb, ng, len(ls), sum(docs_of[x] == top[x[0]] for x in ls), sum(docs_of[x] for x in ls), digest)
            for d, na, nb, ng, ls, digest in aligned]


def check(got, want):
    got, want = (sorted(rows, key=str) for rows in (got, want))
    assert sorted(str(r[:7]) for r in got) == sorted(str(r[:7]) for r in want)
    known = {str(r[:7]): r[7] for r in want if r[7] is not None}
    assert all(known.get(str(r[:7]), r[7]) == r[7] for r in got)


@pytest.mark.parametrize("bucket, chunk, parts", [(1 << 16, 2_000_000, 1_000_000), (40, 200, 300)])
def test_alignment_equals_brute_force(make_docs, monkeypatch, bucket, chunk, parts):
    for name, value in (("BUCKET", bucket), ("CHUNK", chunk), ("PART_ROWS", parts), ("PENDING", 300)):
        monkeypatch.setattr(al, name, value)
    docs = make_docs(CASES).withColumn("a", F.lit(1)).withColumn("_key", F.lit(1))
    got = al.align(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    check([tuple(r) for r in got.collect()], brute(CASES))


def test_alignment_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check([tuple(r) for r in entry.queries()["op13_token_alignment"](spark, SF_SMALL).collect()], brute(rows))


def test_alignment_of_no_documents(make_docs):
    paths = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
    assert al.align(make_docs([]), *paths).count() == 0
    got = al.align(make_docs([(1, None), (2, "")]), *paths).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_perfect_hash_is_minimal_and_perfect():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        keys = np.unique(rnd.integers(0, 2 ** 48, n))
        made = al.PerfectHash.build(keys)
        again = al.PerfectHash.load(*made.dump())
        for h in (made, again):
            assert sorted(h.index(keys).tolist()) == list(range(len(keys)))


def test_scratch_is_removed_on_request(spark, make_docs):
    import os

    from windshear.llm import common

    kept = common._WRITTEN[:]
    common._WRITTEN.clear()
    table = common.stored(make_docs([(1, "a")]), "removed")
    folder = common._WRITTEN[0]
    assert table.count() == 1 and os.path.isdir(folder)
    assert common.clear_scratch(spark) == 1 and not os.path.exists(folder)
    common._WRITTEN.extend(kept)
