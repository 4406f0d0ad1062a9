"""Upsert, removal, roots and rebuild, as set operations on document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexharbor.operators.prefixes import RAW, match_prefixes, starts_within


def latest(batch: DataFrame, order: str = "seq") -> DataFrame:
    """One row per path, the one with the greatest ``order``."""
    rest = [c for c in batch.columns if c not in ("path", order)]
    return (batch.groupBy("path")
            .agg(F.max_by(F.struct(order, *rest), order).alias("row"))
            .select("path", "row.*"))


def one_per_path(rows: DataFrame) -> DataFrame:
    """One row per path: the greatest by the other columns, so reruns agree.

    Where there is an order among the rows of a path, take :func:`latest` first.
    """
    rest = [c for c in rows.columns if c != "path"]
    return rows.groupBy("path").agg(F.max(F.struct(*rest)).alias("row")).select("path", "row.*")


def repeated_paths(rows: DataFrame) -> DataFrame:
    """``(path)`` of the paths that stand in more than one row; only paths are shuffled."""
    return rows.groupBy("path").count().filter(F.col("count") > 1).select("path")


def upsert(base: DataFrame, batch: DataFrame) -> DataFrame:
    """``base`` with the rows of ``batch`` in place of those with the same path.

    ``batch`` has one row per path (see :func:`latest`).
    """
    kept = base.join(batch.select("path"), "path", "left_anti")
    return kept.unionByName(batch.select(*base.columns))


def remove_under(docs: DataFrame, root: str, mode: str = RAW) -> DataFrame:
    """``docs`` without those under one root: a filter the scan can use."""
    return docs.filter(~starts_within(F.col("path"), root, mode))


def paths_under(docs: DataFrame, prefixes: DataFrame, mode: str = RAW) -> DataFrame:
    """Distinct ``path`` of documents under any of ``prefixes(prefix)``."""
    return (match_prefixes(docs.select("path"), prefixes.select("prefix").distinct(), mode)
            .select("path").distinct())


def remove_prefixes(docs: DataFrame, prefixes: DataFrame, mode: str = RAW) -> DataFrame:
    """``docs`` without those under any of ``prefixes(prefix)``."""
    return docs.join(paths_under(docs, prefixes, mode), "path", "left_anti")


def remove_exact(docs: DataFrame, paths: DataFrame) -> DataFrame:
    """``docs`` without the given paths."""
    return docs.join(paths.select("path"), "path", "left_anti")


def register_roots(roots: DataFrame, new: DataFrame) -> DataFrame:
    """``roots(seq, path)`` with ``new(seq, path)`` after them, first entry of a path kept."""
    every = roots.select("seq", "path").unionByName(new.select("seq", "path"))
    return every.groupBy("path").agg(F.min("seq").alias("seq")).select("seq", "path")


def unregister_root(roots: DataFrame, docs: DataFrame, path: str,
                    mode: str = RAW) -> tuple[DataFrame, DataFrame]:
    """Drop a root and the documents under it; no change unless that very root is listed."""
    if roots.filter(F.col("path") == path).isEmpty():
        return roots, docs
    return roots.filter(F.col("path") != path), remove_under(docs, path, mode)


def unregister_roots(roots: DataFrame, docs: DataFrame, gone: DataFrame,
                     mode: str = RAW) -> tuple[DataFrame, DataFrame]:
    """As :func:`unregister_root`, for a table of roots; paths not listed do nothing."""
    listed = gone.select("path").join(roots, "path", "left_semi").distinct()
    left = roots.join(listed, "path", "left_anti").select("seq", "path")
    return left, remove_prefixes(docs, listed.withColumnRenamed("path", "prefix"), mode)


def reindex(base: DataFrame, roots: DataFrame, scan: DataFrame, mode: str = RAW) -> DataFrame:
    """Documents under any root replaced by a fresh scan of all roots, in one job."""
    prefixes = roots.select(F.col("path").alias("prefix"))
    return upsert(remove_prefixes(base, prefixes, mode), scan.select(*base.columns))


def purge(table: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return table.limit(0)
