"""Mixing against its targets, WARC round trips, and the pipeline stage by stage."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare, duck_connection
from llm_helpers import SF_CHECK, SF_SMALL, make_docs  # noqa: F401
from windshear.llm import mixing, pii, suffixes, warc
from windshear.llm.hyperminhash import near_duplicates


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Resharing by hand: cap, share the excess of the capped again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed, free = share * sum(sizes.values()), {}, list(order)
    while free:
        rest = total - sum(fixed.values())
        each = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if each[s] > most * sizes[s]]
        if not over:
            return {**fixed, **each}
        fixed.update({s: most * sizes[s] for s in over})
        free = [s for s in free if s not in over]
    return fixed


def test_mix_of_a_table(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = entry.queries()["op2_entropy_mixing"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    sizes, taken = {}, {}
    for r in got:
        n = len(re.findall("[^\x20\x09-\x0D]+", docs[r["doc_id"]]["text"] or ""))
        s = docs[r["doc_id"]]["source"]
        assert r["size"] == n and r["taken"] in (0, n, 2 * n)
        sizes[s] = sizes.get(s, 0) + n
        taken[s] = taken.get(s, 0) + r["taken"]
    want = targets(sizes)
    biggest = max(r["size"] for r in got)
    for r in got:
        s = docs[r["doc_id"]]["source"]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
    assert all(abs(taken[s] - want[s]) <= biggest for s in want)
    assert "Python" not in entry.queries()["op2_entropy_mixing"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_mix_defined_cases(make_docs):
    rows = [(i, "w " * (i % 7 + 1), "en", "a") for i in range(200)] + [(1000, None, "en", "b"), (1001, "x y", "en", None), (1001, "x y", "en", None),
                                                                      (None, "p q r", "en", "a"), (1002, " ", "en", "empty")]
    got = mixing.mix(make_docs(rows).withColumn("size", F.lit(1)).withColumn("target", F.lit(1))).collect()
    assert len(got) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in got)
    assert sorted((r["taken"], r["target"]) for r in got if r["doc_id"] in (1000, 1002)) == [(0, 0.0), (0, 0.0)]
    again = mixing.mix(make_docs(rows[::-1])).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(make_docs([])).count() == 0


def test_one_size_holds_most_rows(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 16)
    rows = [(i, "same text here", "en", "a") for i in range(900)] + [(2000 + i, "w " * (50 + i), "en", "b") for i in range(40)]
    got = mixing.mix(make_docs(rows)).collect()
    for s in (0, 1):
        part = [r for r in got if (r["doc_id"] >= 2000) == bool(s)]
        assert abs(sum(r["taken"] for r in part) - part[0]["target"]) <= max(r["size"] for r in part)


NASTY = "a" * 120 + "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99999\r\n\r\n é"


def test_warc_round_trip(spark):
    rows = [(1, "http://a/\r\nb", "x" * 150), (2, "u", "x" * 150), (3, None, None), (4, "u", ""), (5, "u", NASTY), (6, "u", NASTY),
            (None, "u", "WARC/1.1\r\n"), (7, "u", "short"), (8, "u", "short"), (9, "u", "WWARC/1.1\r\n\r\n" * 30), (10, "u", "ü" * 5000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    got = {r["page_id"]: r for r in warc.round_trip(df.repartition(3)).collect()}
    assert len(got) == len(rows)
    for page_id, _, html in rows:
        b = (html or "").encode()
        r = got[page_id]
        assert (r["payload_bytes"], r["payload_digest"], r["digest_ok"]) == (len(b), hashlib.sha256(b).hexdigest(), True)
        assert (r["record_type"], r["refers_to"]) == (("revisit", page_id - 1) if page_id in (2, 6) else ("response", None))
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_scanned_in_small_ranges(spark):
    """Ranges that begin anywhere in a record, also within a magic."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = [(i, f"u{i}", NASTY[: 40 + 9 * i] + str(i) * 200) for i in range(24)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4999")
    try:
        got = warc.round_trip(df).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {r["page_id"]: r["payload_digest"] for r in got} == {i: hashlib.sha256(t.encode()).hexdigest() for i, _, t in rows}


def test_broken_archive_raises(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\ncut")
    with pytest.raises(Exception, match="breaks off"):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_warc_query_matches_sql(spark):
    ok, message = compare(entry.queries()["op3_boundary_chain"](spark, SF_CHECK), duck_connection(SF_CHECK), entry.oracle_sql()["op3_boundary_chain"])
    assert ok, message


def test_pipeline_stages(spark):
    """Each stage on its predecessor's output: columns, and what it removes."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        rows = out.collect()
        seen[name] = (docs.count(), len(rows))
        if name != "mixing":
            assert out.columns == columns
        before = {r["doc_id"]: r for r in docs.collect()}
        if name == "near_duplicates":
            kept = {r["doc_id"] for r in near_duplicates(docs, 5, 80).where("kept").collect()}
            assert {r["doc_id"] for r in rows} == kept
        if name == "decontamination":
            clean = suffixes.contamination(docs, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).where("n_hit = 0")
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in clean.collect()}
        if name == "personal_data":
            assert all(r["text"] == pii.redacted(before[r["doc_id"]]["text"]) and r["n_chars"] == len(r["text"] or "") for r in rows)
        if name == "mixing":
            assert max(r["copy"] for r in rows) <= 2 and {r["doc_id"] for r in rows} <= set(before)
        docs = spark.createDataFrame(rows, out.schema)
    assert all(after <= before for name, (before, after) in seen.items() if name != "mixing") and seen["near_duplicates"][1] < seen["near_duplicates"][0]


def test_pipeline_run(spark):
    out = entry.queries()["pipeline"](spark, SF_SMALL)
    assert "copy" in out.columns and out.count() > 0


def test_repeated_rows_meet_the_target(make_docs, monkeypatch):
    """A third of all rows agree in id, source and text at a rate that is no whole number; copies differ between them."""
    monkeypatch.setattr(mixing, "RUN", 100)
    ten = " ".join(["w"] * 10)
    rows = [(i, "v " * (i % 9 + 1), "en", "a") for i in range(1500)] + [(None, ten, "en", "b")] * 3000
    docs = make_docs(rows).withColumn("size", F.lit(1)).withColumn("copy", F.lit("x")).repartition(5)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    mine = [r for r in got if r["doc_id"] is None]
    assert len(mine) == 3000 and 0 < mine[0]["target"] < 2 * mine[0]["source_size"]
    assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 10 and len({r["taken"] for r in mine}) == 2
    out = mixing.mixed_rows(docs.drop("copy"))
    assert out.columns == [*docs.columns[:-1], "copy"]
    taken = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert taken.get(None) == sum(r["taken"] for r in mine) // 10
    assert {k: v for k, v in taken.items() if k is not None} == {
        r["doc_id"]: r["taken"] // r["size"] for r in got if r["doc_id"] is not None and r["taken"]}


def test_rates_that_do_not_converge_raise(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    with pytest.raises(RuntimeError, match="converge"):
        mixing.mix(make_docs([(i, "v " * (i % 9 + 1), "en", "ab"[i % 2]) for i in range(60)]))
