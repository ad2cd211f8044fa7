"""Secret candidates and a random forest that removes false positives.

Candidates are all runs of at least ``LEAST`` characters ``A-Z a-z 0-9 + / _ -``, wherever they stand
in a word of the text and however many the word has. Each is described by

* its length, shares of digits, capitals and distinct characters, and whether it is hexadecimal;
* character transitions: changes between lower case, capitals and digits per character;
* dictionary coverage: the share of it made of letter runs that are common words of the
  corpus (words on at least ``COMMON`` of all documents; by the mean number
  of distinct words this list has at most mean / ``COMMON`` entries);
* the path: whether the source names tests or examples, or configuration;
* neighbouring words: the share of them that are common words of the corpus, and words like "example" around it.
  Neighbours are the rest of its word as far as the next run, which is included, and the neighbouring words; of
  these, runs that do not stand next to them see the nearest ``NEAR`` characters, so that words of
  many runs stay linear.

The forest is trained on labelled findings, at most ``SAMPLE_ROWS`` of each class by smallest
hash. They are given as ``labelled(doc_id, at, place, label)``, as a reviewer leaves them, or else come from signals
that are no features of the forest: a fixed provider format, or a key name and an assignment before the value,
stands for a secret; a value in running text, without key name, assignment or quote before it, for none; all others are scored
only. The forest so learns from value, path and neighbours what the signals say of how a value is introduced, and
overrules them where they are wrong: a plain word assigned to a key, a random value in a sentence.

Everything is DataFrame operations and Spark's own forest. Defined cases: null,
empty and blank texts have no candidates; repeated rows are each reported; a null source has
neither path flag; if a class has no labelled finding no forest is
trained, and labelled secrets score 1, all else 0; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windshear.llm.common import small_enough, stored

LEAST = 16
COMMON = 0.005
NEAR = 64
SAMPLE_ROWS = 10_000
TREES, DEPTH, SEED = 30, 6, 7

_SPACE = r"[\x20\x09-\x0D]+"
# Possessive and bound to the start of a run, so that long words cost linear time.
_RUN = rf"(?<![A-Za-z0-9+/_\-])([A-Za-z0-9+/_\-]{{{LEAST},}}+)"
# Words that name a secret, and words that mark an example.
_KEY = r"(?i)(pass|pwd|secret|token|api.?key|apikey|access.?key|auth|cred|bearer|private)"
_EXAMPLE = r"(?i)(example|sample|dummy|placeholder|your|fake|xxxx|test)"
_PROVIDER = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{16,}|AIza[0-9A-Za-z_\-]{35}|xox[abpr]-[A-Za-z0-9\-]{10,})$"
FEATURES = ["length", "digits", "capitals", "distinct", "hex", "transitions", "coverage", "path_test", "path_config",
            "prose", "example_near"]
HOT = 1000


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("double")


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: ``(doc_id, source, at, place, value, lead, before, before2, after)``; ``at`` is
    the word's number and ``place`` the run's within the word."""
    words = F.split(F.coalesce("text", F.lit("")), _SPACE)
    word = lambda i: F.coalesce(F.get("w", i), F.lit(""))
    likely = F.filter(F.transform("w", lambda x, i: F.when((F.length(x) >= LEAST) & x.rlike(_RUN), i)), lambda i: i.isNotNull())
    near = F.transform("i", lambda i: F.struct(i.cast("long").alias("at"), word(i).alias("word"), word(i - 1).alias("before"),
                                               word(i - 2).alias("before2"), word(i + 1).alias("after")))
    rows = (docs.select("doc_id", "source", words.alias("w")).select("doc_id", "source", "w", likely.alias("i"))
            .where(F.size("i") > 0).select("doc_id", "source", F.explode(near).alias("c")).select("doc_id", "source", "c.*"))
    cut = rows.withColumns({"runs": F.regexp_extract_all("word", F.lit(_RUN), F.lit(1)), "gaps": F.split("word", _RUN)}).drop("word")
    run = lambda i: F.coalesce(F.get("runs", i), F.lit(""))
    parts = F.transform("runs", lambda v, i: F.struct(i.cast("long").alias("place"), v.alias("value"),
                                                      F.concat(run(i - 1), F.get("gaps", i)).alias("lead"),
                                                      F.concat(F.get("gaps", i + 1), run(i + 1)).alias("tail"),
                                                      F.when(i == 0, F.col("before")).otherwise(F.right("before", F.lit(NEAR))).alias("before"),
                                                      F.when(i == 0, F.col("before2")).otherwise(F.right("before2", F.lit(NEAR))).alias("before2"),
                                                      F.when(i == F.size("runs") - 1, F.col("after")).otherwise(F.left("after", F.lit(NEAR))).alias("after")))
    found = cut.select("doc_id", "source", "at", F.explode(parts).alias("c")).select("doc_id", "source", "at", "c.*")
    return found.withColumn("after", F.concat_ws(" ", "tail", "after")).drop("tail")


def dictionary(docs: DataFrame, common: float = COMMON) -> DataFrame:
    """``(word)``: lower-case letter runs of three or more on at least ``common`` of the documents."""
    total = docs.count()
    runs = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+"))
    return (docs.select(F.explode(runs).alias("word")).where(F.length("word") >= 3).groupBy("word").count()
            .where(F.col("count") >= max(2, common * total)).select("word"))


def _coverage(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``rows`` with ``coverage``, computed once for each distinct value; the words are bounded (see above) and broadcast.
    A value with over ``HOT`` rows is met in as many parts as it has so many."""
    values = rows.groupBy("value").agg(F.count("*").alias("k")).withColumn("parts", F.ceil(F.col("k") / HOT))
    runs = values.select("value", "parts", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    known = (runs.join(F.broadcast(words), "word").groupBy("value", "parts").agg(F.sum(F.length("word")).alias("known"))
             .select("value", (F.col("known") / F.length("value")).alias("coverage"),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")))
    hot = stored(values.where("parts > 1").select("value", "parts"), "hot")
    part = F.pmod(F.xxhash64("doc_id", "at", "place"), F.coalesce("parts", F.lit(1)))
    dealt = rows.join(F.broadcast(hot) if small_enough(hot) else hot, "value", "left").withColumn("part", part).drop("parts")
    return dealt.join(known, ["value", "part"], "left").drop("part").withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))


def _prose(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``rows`` with ``prose``: of the two words before and the one after, those that hold three letters in a row, the share that are
    common words. Signs such as that of an assignment are no words and don't show in it."""
    near = F.array(*[F.regexp_extract(F.lower(F.col(c)), "([a-z]{3,})[^a-z]*$" if c != "after" else "^[^a-z]*([a-z]{3,})", 1)
                     for c in ("before2", "before", "after")])
    # The bounded list is met word by word, each join a lookup in it.
    out = rows.withColumn("_near", near).withColumn("prose", F.lit(0.0))
    for i in range(3):
        side = words.select(F.col("word").alias("_word"), F.lit(1.0).alias("_is"))
        out = (out.join(F.broadcast(side), F.get("_near", F.lit(i)) == F.col("_word"), "left")
               .withColumn("prose", F.col("prose") + F.coalesce("_is", F.lit(0.0))).drop("_word", "_is"))
    present = F.size(F.filter("_near", lambda w: w != ""))
    return out.withColumn("prose", F.col("prose") / F.greatest(present, F.lit(1))).drop("_near")


def describe(rows: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates with the columns of ``FEATURES``, and what the rule of labels reads."""
    v, size = F.col("value"), F.length("value")
    changes = r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])"
    around = F.concat_ws(" ", "before2", "before", "lead", "after")
    ahead = F.concat_ws(" ", "before2", "before", "lead")
    words = stored(words, "dictionary")
    rows = _prose(_coverage(rows, words), words)
    path = F.coalesce("source", F.lit(""))
    return (rows.withColumn("length", size.cast("double"))
            .withColumn("digits", F.regexp_count(v, F.lit("[0-9]")) / size)
            .withColumn("capitals", F.regexp_count(v, F.lit("[A-Z]")) / size)
            .withColumn("distinct", F.size(F.array_distinct(F.split(v, ""))) / size)
            .withColumn("hex", _flag(v.rlike("^[0-9a-fA-F]+$")))
            .withColumn("transitions", F.regexp_count(v, F.lit(changes)) / size)
            .withColumn("path_test", _flag(path.rlike(r"(?i)(test|example|sample|fixture|doc)")))
            .withColumn("path_config", _flag(path.rlike(r"(?i)(conf|env|setting|\.ya?ml|\.json|propert)")))
            .withColumn("key_near", _flag(ahead.rlike(_KEY)))
            .withColumn("assigned", _flag(F.concat("before", "lead").rlike("[=:]")))
            .withColumn("quoted", _flag(F.col("lead").rlike("[\"'`]$")))
            .withColumn("example_near", _flag(around.rlike(_EXAMPLE))))


def rule_label() -> Column:
    """1 or 0 by how a value is introduced or its provider's format, else null; no input of it is a feature."""
    introduced = (F.col("key_near") == 1) & (F.col("assigned") == 1)
    plain = (F.col("key_near") == 0) & (F.col("assigned") == 0) & (F.col("quoted") == 0)
    return F.when(F.col("value").rlike(_PROVIDER) | introduced, 1).when(plain, 0).cast("double")


def train(findings: DataFrame, rows: int = SAMPLE_ROWS):
    """A forest from ``findings`` with FEATURES and ``label`` (null: not used); None if a class is missing."""
    known = findings.where(F.col("label").isNotNull()).withColumn("h", F.xxhash64("value", "before"))
    cols = [*FEATURES, "label"]
    picked = None
    for y in (0.0, 1.0):
        part = known.where(F.col("label") == y).orderBy("h", *FEATURES).limit(rows).select(*cols)
        picked = part if picked is None else picked.union(part)
    picked = stored(picked, "findings")
    if picked.select("label").distinct().count() < 2:
        return None
    data = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(picked)
    return RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(data)


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """Every candidate of ``docs(doc_id, text, source)``: ``(doc_id, at, place, value_sha256, length, label, probability, secret)``.

    ``labelled(doc_id, at, place, label)`` are reviewed findings, 1 or 0; where several rows label one place, the largest counts."""
    rows = stored(candidates(docs), "candidates")
    described = describe(rows, dictionary(docs))
    if labelled is None:
        described = described.withColumn("label", rule_label())
    else:
        given = labelled.groupBy("doc_id", "at", "place").agg(F.max("label").cast("double").alias("label"))
        described = described.join(given, ["doc_id", "at", "place"], "left")
    found = stored(described, "described")
    forest = train(found)
    if forest is None:
        scored = found.withColumn("probability", F.coalesce("label", F.lit(0.0)))
    else:
        scored = forest.transform(VectorAssembler(inputCols=FEATURES, outputCol="x").transform(found))
        scored = scored.withColumn("probability", vector_to_array("probability")[1])
    return scored.select("doc_id", "at", "place", F.sha2("value", 256).alias("value_sha256"), F.col("length").cast("long").alias("length"),
                         F.col("label").cast("int").alias("label"), "probability", (F.col("probability") >= threshold).alias("secret"))
