"""An index as a set of tables, built from documents or opened from a snapshot."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexharbor.functions.text import kept_length, path_bucket, term_slot
from lexharbor.operators import lookup
from lexharbor.operators import postings as P
from lexharbor.operators.analysis import DEFAULT, Registry
from lexharbor.session import BROADCAST_ROWS

# Languages of a table of queries that are put into the scan; with more, slots alone prune.
SCANNED_LANGS = 1000


@dataclass(frozen=True)
class Reach:
    """How far a table of query terms reaches: enough to prune a scan, whatever its size."""

    rows: int
    langs: list[str]
    slots: list[int]
    low: str | None
    high: str | None


@dataclass
class Index:
    """``docs(path, lang, title, body)`` and the tables derived from it.

    ``terms(lang, field, term, df, ttf)`` and ``fields(lang, field, n_docs, sum_len)``
    may hold partial counts, one per bucket of documents; readers add them up.
    """

    docs: DataFrame
    postings: DataFrame
    terms: DataFrame
    fields: DataFrame
    registry: Registry = DEFAULT
    exact_len: bool = False
    stored: bool = False
    # the stored documents with their bucket, and how many buckets there are
    by_bucket: DataFrame | None = None
    buckets: int = 0
    # into how many folders the terms of a stored index are hashed
    slots: int = 1

    def docs_of(self, hits: DataFrame, rows: int) -> DataFrame:
        """The documents a join with ``hits(path)`` may need; ``rows`` bounds the hits.

        A stored index keeps each bucket in a folder of its own, so only the folders of the
        hits' paths are opened. There are no more bucket numbers than buckets.
        """
        if self.by_bucket is None or rows > BROADCAST_ROWS:
            return self.docs
        wanted = hits.select(path_bucket(F.col("path"), self.buckets).alias("b")).distinct()
        return self.by_bucket.filter(F.col("bucket").isin([r["b"] for r in wanted.collect()]))

    def norm(self, length: Column) -> Column:
        """Length as the ranking sees it: kept in one byte unless ``exact_len``."""
        return length if self.exact_len else kept_length(length)

    def term_stats(self) -> DataFrame:
        return (self.terms.groupBy("lang", "field", "term")
                .agg(F.sum("df").alias("df"), F.sum("ttf").alias("ttf")))

    def expansions(self, words: DataFrame, n: int = lookup.MAX_EXPANSIONS) -> DataFrame:
        """The ``n`` best expansions of ``words(lang, field, word)`` with document frequencies."""
        return lookup.fuzzy_expand(self.term_stats(), words, n)

    def field_stats(self) -> DataFrame:
        """One row per language and field."""
        return (self.fields.groupBy("lang", "field")
                .agg(F.sum("n_docs").alias("n_docs"), F.sum("sum_len").alias("sum_len"))
                .withColumn("avg_len", F.col("sum_len") / F.col("n_docs")))

    def lengths(self) -> DataFrame:
        return P.lengths_of(self.postings)

    def reach(self, terms: DataFrame) -> Reach:
        """Rows of ``terms(lang, term, …)``, their languages, folders and first and last term.

        One small job; the slots are no more than the index has, however many the terms.
        """
        langs = F.array_compact(F.collect_set("lang"))
        found = terms.agg(
            F.count(F.lit(1)).alias("rows"), langs.alias("langs"),
            F.collect_set(term_slot(F.col("term"), self.slots)).alias("slots"),
            F.min("term").alias("low"), F.max("term").alias("high")).first()
        return Reach(found["rows"], sorted(found["langs"]), sorted(found["slots"]),
                     found["low"], found["high"])

    def _pruned(self, table: DataFrame, reach: Reach, slotted: bool) -> DataFrame:
        if not self.stored:
            return table
        if reach.low is None:
            return table.filter(F.lit(False))
        if len(reach.langs) <= SCANNED_LANGS:
            table = table.filter(F.col("lang").isin(reach.langs))
        if slotted and self.slots > 1:
            table = table.filter(F.col("slot").isin(reach.slots))
        return table.filter(F.col("term").between(reach.low, reach.high))

    def postings_within(self, reach: Reach) -> DataFrame:
        """The postings a join with the terms of ``reach`` may need.

        A stored index keeps the terms of each language, field and slot in a folder of their
        own, sorted: only folders some term falls into are opened, and in those only the pages
        between the first and the last term are read. One plan for any number of terms.
        """
        return self._pruned(self.postings, reach, True)

    def term_stats_of(self, wanted: DataFrame, reach: Reach) -> DataFrame:
        """Statistics of the wanted (lang, field, term) only; ``reach`` is theirs."""
        found = self._pruned(self.terms, reach, False).join(
            wanted, ["lang", "field", "term"], "left_semi")
        return found.groupBy("lang", "field", "term").agg(
            F.sum("df").alias("df"), F.sum("ttf").alias("ttf"))


def partial_terms(postings: DataFrame, *by: str) -> DataFrame:
    return (postings.groupBy(*by, "lang", "field", "term")
            .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("ttf")))


def partial_fields(postings: DataFrame, *by: str) -> DataFrame:
    return (postings.filter("first").groupBy(*by, "lang", "field")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("len").cast("long").alias("sum_len")))


def build_index(docs: DataFrame, registry: Registry = DEFAULT, exact_len: bool = False) -> Index:
    """An index over ``docs(path, lang, title, body)``, not yet stored anywhere.

    Every table is a plan over ``docs``; store it with :mod:`lexharbor.plans.snapshot`
    when it is to be searched more than once.
    """
    docs = docs.select("path", "lang", "title", "body")
    rows = P.postings(docs, registry)
    return Index(docs, rows, partial_terms(rows), partial_fields(rows), registry, exact_len)
