"""From raw documents to token files: five stages, each on all that its predecessor kept.

1. toxicity: documents that the classifier predicts as toxic go.
2. near_duplicates: of documents alike in four fifths of their five-word shingles one stays.
3. decontamination: documents that hold four fifths of a benchmark item's shingles go.
4. mixing: documents are repeated or left out so that sources come to their target weights.
5. tokens: what is left is written as token shards and read back.

Each stage is a function of (spark, docs, sf_dir); all but the last return the columns of
``documents``. Every stage takes empty tables, null texts and ids, repeated rows and extra columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexharbor.llm import containment, mixing, neardup, tokens, toxicity
from lexharbor.llm.common import documents_of
from lexharbor.session import materialize


def fresh(name: str, docs: DataFrame) -> str:
    """``name``, made longer until no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a hash of id and text, so a null or repeated id judges no other text.

    The name of the key's column comes with it; the stage drops it before it returns.
    """
    key = fresh("stage_key", docs)
    return docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), "text")), key


def by_key(docs: DataFrame, key: str) -> DataFrame:
    """What an operator reads of keyed ``docs``: the key in place of the id."""
    return docs.select(F.col(key).alias("doc_id"), "text")


def without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows of keyed ``docs`` whose key is not among ``gone``."""
    return docs.join(gone.select(key).distinct(), key, "left_anti").drop(key)


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on the labelled rows of ``documents``; a score under the threshold stays."""
    model = toxicity.train(documents_of(spark, sf_dir), documents_of(spark, sf_dir, "labels"))
    # columns of the input that are called like the classifier's keep their values
    own = {c: fresh(f"given_{c.lower()}", docs) for c in docs.columns
           if c.lower() in ("score", "predicted", "flagged")}
    scored = toxicity.score(docs.withColumnsRenamed(own), model)
    return (scored.filter("predicted = 0").drop("score", "predicted", "flagged")
            .withColumnsRenamed({b: a for a, b in own.items()}).select(docs.columns))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each component stays, null ids last.

    Rows that repeat an id and its text are one document. Rows of null id are documents each, so
    of those with the same words one stays too.
    """
    rows, key = keyed(docs)
    found = neardup.near_duplicates(by_key(rows, key)).select(F.col("doc_id").alias(key), "component_id")
    judged = materialize(found.distinct().join(rows.select(key, "doc_id").distinct(), key), "judged")
    first = judged.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key)).alias("first"))
    gone = judged.join(first.select(F.col(f"first.{key}").alias(key)), key, "left_anti")
    kept = without(rows, gone, key)
    if docs.filter("doc_id IS NULL").isEmpty():
        return kept
    single = F.col("doc_id").isNull() & (mixing.words_in() > 0)
    return kept.filter(~single).unionByName(kept.filter(single).dropDuplicates(["text"]))


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, key = keyed(docs)
    found = containment.contained_items(by_key(rows, key), documents_of(spark, sf_dir, "benchmark"))
    return without(rows, found.select(F.col("doc_id").alias(key)), key)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document taken twice is two rows; every row is taken as often as the mix says of it."""
    key, times, copy = (fresh(c, docs) for c in ("stage_key", "mix_repeats", "mix_copy"))
    rows = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "mix-rows")
    taken = (mixing.mix(rows, carry=(key,)).filter("repeats > 0")
             .select(key, F.col("repeats").cast("int").alias(times)))
    return (rows.join(taken, key)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
            .select(docs.columns))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.tokenised(spark, docs)


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", near_duplicates_out),
    ("decontamination", benchmark_out),
    ("mixing", mixed),
    ("tokens", token_files),
]

# The stages' classifier, sketches and tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written before the next reads them."""
    docs = documents_of(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
