"""Hit counts, ranks, limits and document fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexharbor.session import BROADCAST_ROWS, broadcast_within, count_up_to, materialize


def hit_counts(hits: DataFrame) -> DataFrame:
    """``(query_id, n_hits)``: all matches, whatever limit is shown."""
    return hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_hits"))


def check_limit(k: int | None) -> int | None:
    """``None`` or 0 mean unlimited; a negative limit is an error."""
    if k is None or k == 0:
        return None
    if k < 0:
        raise ValueError("limit must not be negative")
    return k


def top_k(hits: DataFrame, k: int) -> DataFrame:
    """The first ``k`` hits of each query; each task keeps k per query before the shuffle."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "path")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def rank_all(hits: DataFrame) -> DataFrame:
    """Rank every hit of every query without gathering a query in one task.

    A query may hit a third of all documents. The hits, best read from a stored table, are dealt
    to the tasks by ranges of (query, score, path), sorted and stored with their place. A hit's
    rank is its place among its query's hits of the task, plus how many hits of the query lie in
    the ranges before. Only those counts are joined, one row for each query and range it touches.
    """
    order = ["query_id", F.desc("score"), "path"]
    placed = materialize(
        hits.repartitionByRange(*order).sortWithinPartitions(*order).select(
            *hits.columns, F.spark_partition_id().alias("range"),
            F.monotonically_increasing_id().alias("place")), "ranges")
    before = Window.partitionBy("query_id").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)
    sizes = (placed.groupBy("query_id", "range")
             .agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
             .withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .drop("n"))
    rows = count_up_to(sizes, BROADCAST_ROWS)
    return (placed.join(broadcast_within(sizes, rows), ["query_id", "range"])
            .withColumn("rank", (F.col("ahead") + F.col("place") - F.col("first") + 1).cast("int"))
            .select(*hits.columns, "rank"))


def ranked(hits: DataFrame, k: int | None = None) -> DataFrame:
    """``(query_id, path, score, rank)`` best first, equal scores by path."""
    k = check_limit(k)
    return rank_all(hits) if k is None else top_k(hits, k)


def fetch(ranked: DataFrame, docs: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """Stored fields of ranked hits; ``rows`` is the proven bound k × queries."""
    return docs.select("path", *columns).join(broadcast_within(ranked, rows), "path")
