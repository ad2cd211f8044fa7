"""A training-data pipeline over ``documents``: toxic documents go, one document of each
near-duplicate group stays, documents with benchmark passages go, personal data is
replaced, and the sources are mixed to their target weights.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``. All
but the last return the columns of ``documents``; the last adds ``copy``, the number of
the repetition of a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from windshear.llm import hyperminhash, mixing, pii, suffixes, toxicity
from windshear.llm.common import read_table, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, threshold=0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hyperminhash.keep_one(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.keep_uncontaminated(docs, read_table(spark, sf_dir, "benchmark"), size=10)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
]

# Trained scores, sketches and rewritten texts are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
