"""Views over the given tables: documents, queries, roots, change events."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexharbor.functions.text import title_of, words_of
from lexharbor.operators.analysis import PLAIN, Registry, Tables
from lexharbor.plans.index import Index
from lexharbor.plans.snapshot import Snapshots
from lexharbor.session import materialize, scratch_path

QUERY_BASE = 100_000
PHRASE_BASE = 500_000_000_000
PREFIX_BASE = 900_000_000_000
# Files that one task writes and lists, and so many folders that they are listed as a Spark job.
SHELF_FILES, LEAST_SHELVES = 1000, 64

_stored: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a table that Spark reads in fewer tasks than there are cores over all of them.

    Text work is heavy and a small file is one task; a table that comes in many tasks,
    of one big file or of many, is read as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(2 * cores, *keys)


def doc_path():
    return F.concat(F.lit("/corpus/"), "source", F.lit("/"), "source", F.lit("."), "lang",
                    F.lit("."), F.col("doc_id").cast("string"), F.lit(".txt"))


def docs_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, source, path, lang, title, body)``."""
    rows = table(spark, sf_dir, "documents").withColumn("path", doc_path())
    wide = spread(rows.select("doc_id", "source", "path", "lang", "text"), "path")
    return wide.select("doc_id", "source", "path", "lang",
                       title_of(F.col("path")).alias("title"), F.col("text").alias("body"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs_with_id(spark, sf_dir).select("path", "lang", "title", "body")


def stored_index(spark: SparkSession, sf_dir: str, registry: Registry = PLAIN,
                 name: str = "plain") -> Index:
    """The documents indexed once per application and ``name``, read from the stored snapshot."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        rows = docs(spark, sf_dir)
        buckets = min(4096, max(8, rows.count() // 100_000))
        root = scratch_path(spark, "index")
        Snapshots(spark, root, registry, buckets=buckets).publish(rows)
        _stored[key] = root
    return Snapshots(spark, _stored[key], registry).open()


OTHER_LANGS = ("de", "es", "fr")


def language_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Tables from the data for bodies not in English: terms of up to three letters are stop
    words, and a final s of longer ones is cut. Words asked for are in the tables too."""
    langs = F.array(*[F.lit(x) for x in OTHER_LANGS])
    held = (docs(spark, sf_dir).filter(F.col("lang").isin(*OTHER_LANGS))
            .select("lang", F.explode(F.array_distinct(F.transform(
                words_of(F.col("body")), F.lower))).alias("term")))
    asked = words(spark, sf_dir).select(F.explode(langs).alias("lang"), F.col("word").alias("term"))
    terms = materialize(held.unionByName(asked).distinct(), "words")
    return Tables(OTHER_LANGS, terms.filter(F.length("term") <= 3), terms.filter(
        F.col("term").endswith("s")).select(
            "lang", "term", F.expr("substring(term, 1, length(term) - 1)").alias("stem")))


def folder_name(key: str, value: str | None) -> str:
    """``key=value`` as Spark names the folder of a partition."""
    value = re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda c: f"%{ord(c[0]):02X}", value or "")
    return f"{key}={value or '__HIVE_DEFAULT_PARTITION__'}"


def write_tree(rows: DataFrame, folders: list[str], text: str, end: str, root: str) -> None:
    """Each value of ``folders`` as a text file of its own under ``root``: its texts, an ``end`` each.

    One task writes all of a shelf, the topmost folder, so a listing deals shelves to tasks. Where
    the shared folder is mounted, tasks write the files themselves: Spark's writer makes a folder,
    a checksum and, without Hadoop's native library, processes to set their rights for each file.
    """
    shelves = max(LEAST_SHELVES, -(-rows.count() // SHELF_FILES))
    dealt = (rows.select(F.pmod(F.xxhash64(*folders), F.lit(shelves)).cast("int").alias("shelf"),
                         *folders, F.col(text).alias("value"))
             .repartition(shelves, "shelf"))
    if re.match(r"(?!file:)[A-Za-z][A-Za-z0-9+.-]*:", root):
        dealt.write.partitionBy("shelf", *folders).option("lineSep", end).text(root)
        return
    mount = re.sub("^file:/+", "/", root)
    keys = ["shelf", *folders]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            for *key, value in zip(*(b.column(c).to_pylist() for c in (*keys, "value")), strict=True):
                folder = os.path.join(mount, *map(folder_name, keys, key))
                if key != last:
                    os.makedirs(folder, exist_ok=True)
                with open(f"{folder}/part.txt", "ab" if key == last else "wb") as file:
                    file.write(((value or "") + end).encode())
                last = key
        yield pa.RecordBatch.from_pydict({"done": pa.array([True])})

    named = [F.col(c).cast("string").alias(c) for c in keys]
    dealt.select(*named, "value").sortWithinPartitions(*keys).mapInArrow(
        write, "done boolean").count()


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, word)``: every distinct word of the benchmark texts, first place kept."""
    rows = table(spark, sf_dir, "benchmark").select(
        "item_id", F.posexplode(words_of(F.col("text"))).alias("pos", "word"))
    return (rows.groupBy(F.lower("word").alias("word"))
            .agg(F.min(F.col("item_id") * QUERY_BASE + F.col("pos")).alias("query_id"))
            .select("query_id", "word"))


def word_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(spark, sf_dir).select(
        "query_id", F.lit("term").alias("kind"), F.lit("en").alias("lang"),
        F.col("word").alias("text"))


def phrase_queries(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    """Every benchmark text cut into runs of ``n`` words, all of them."""
    all_words = words_of(F.col("text"))
    runs = (table(spark, sf_dir, "benchmark").select("item_id", all_words.alias("w"))
            .filter(F.size("w") > 0)
            .select("item_id", "w", F.explode(
                F.sequence(F.lit(0), F.size("w") - 1, F.lit(n))).alias("at")))
    return runs.select(
        (F.col("item_id") * QUERY_BASE + F.col("at") + PHRASE_BASE).alias("query_id"),
        F.lit("phrase").alias("kind"), F.lit("en").alias("lang"),
        F.array_join(F.slice("w", F.col("at") + 1, F.lit(n)), " ").alias("text"))


def typo_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct benchmark word, its second and third letters swapped."""
    w = F.col("word")
    typo = F.concat(F.substring(w, 1, 1), F.substring(w, 3, 1), F.substring(w, 2, 1),
                    F.substring(w, F.lit(4), F.length(w)))
    return (words(spark, sf_dir)
            .select((-F.col("query_id") - 1).alias("query_id"), F.lit("fuzzy").alias("kind"),
                    F.lit("en").alias("lang"), typo.alias("text")))


def folder_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source folder as a path prefix, without a closing slash."""
    return (table(spark, sf_dir, "documents").groupBy("source")
            .agg((F.min("doc_id") + PREFIX_BASE).alias("query_id"))
            .select("query_id", F.lit("prefix").alias("kind"), F.lit("en").alias("lang"),
                    F.concat(F.lit("/corpus/"), "source").alias("text")))


def roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source folder, in order of its first document."""
    return (table(spark, sf_dir, "documents").groupBy("source")
            .agg(F.min("doc_id").alias("seq"))
            .select("seq", F.concat(F.lit("/corpus/"), "source").alias("path")))


def first_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(prefix)``: for each language, the folder of its first document."""
    return (table(spark, sf_dir, "documents").groupBy("lang")
            .agg(F.min_by("source", "doc_id").alias("source"))
            .select(F.concat(F.lit("/corpus/"), "source").alias("prefix")).distinct())


def changes_of(events: DataFrame) -> DataFrame:
    """``(seq, kind, path, lang, title, body)`` from an events table or stream."""
    kind = (F.when(F.col("event_type") == "signup", "CREATE")
            .when(F.col("event_type").isin("view", "click"), "MODIFY")
            .when(F.col("event_type") == "error", "DELETE").otherwise("OVERFLOW"))
    folder = F.concat(F.lit("/corpus/u"), F.col("user_id").cast("string"))
    file = F.concat(folder, F.lit("/"), (F.col("event_id") % 5).cast("string"), F.lit(".txt"))
    path = F.when(kind.isin("CREATE", "MODIFY"), file).when(kind == "DELETE", folder)
    return events.select(F.col("event_id").alias("seq"), kind.alias("kind"), path.alias("path"),
                         F.lit("en").alias("lang"), title_of(path).alias("title"),
                         F.col("props").alias("body"))


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes_of(table(spark, sf_dir, "events"))
