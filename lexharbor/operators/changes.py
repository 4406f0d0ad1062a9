"""Change events: fold a batch into live documents, diff two listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexharbor.operators.maintain import latest
from lexharbor.operators.prefixes import RAW, SEGMENT, check_mode, match_prefixes

# Kinds of change.
CREATE, MODIFY, DELETE, OVERFLOW = "CREATE", "MODIFY", "DELETE", "OVERFLOW"


def change_counts(events: DataFrame) -> DataFrame:
    """``(kind, n)``; overflow is counted, as the sign that a listing diff is due."""
    return events.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def events_in_roots(events: DataFrame, roots: DataFrame, mode: str = RAW) -> DataFrame:
    """Events on paths under a live root. ``seq`` identifies an event."""
    found = match_prefixes(events.select("seq", "path"),
                           roots.select(F.col("path").alias("prefix")).distinct(), mode)
    return events.join(found.select("seq").distinct(), "seq", "left_semi")


def deaths_of_roots(events: DataFrame, roots: DataFrame) -> DataFrame:
    """``(path, died)``: roots that a deletion names, or lie in a folder it names, and its ``seq``."""
    deleted = (events.filter(F.col("kind") == DELETE)
               .groupBy(F.col("path").alias("prefix")).agg(F.min("seq").alias("seq")))
    return (match_prefixes(roots.select("path"), deleted, SEGMENT)
            .groupBy("path").agg(F.min("seq").alias("died")))


def events_while_alive(events: DataFrame, roots: DataFrame, deaths: DataFrame,
                       mode: str = RAW) -> DataFrame:
    """Events under a root that had not died before them, and the deletions that roots died of.

    Overflow has no path and is dropped.
    """
    known = (roots.select("path").distinct().join(deaths, "path", "left")
             .withColumnRenamed("path", "prefix"))
    found = (match_prefixes(events.select("seq", "path"), known, mode)
             .filter("died is null or seq <= died"))
    counted = found.select("seq").unionByName(deaths.select(F.col("died").alias("seq")))
    return events.join(counted.distinct(), "seq", "left_semi")


def removals(events: DataFrame, mode: str = RAW) -> DataFrame:
    """``(prefix, del_seq)``: the last removal of each path.

    A modification is a removal followed by an addition, so by raw prefixes it also takes
    the other paths that begin with its own; its own write has the same ``seq`` and stays.
    """
    kinds = [DELETE, MODIFY] if mode == RAW else [DELETE]
    return (events.filter(F.col("kind").isin(kinds))
            .groupBy(F.col("path").alias("prefix")).agg(F.max("seq").alias("del_seq")))


def fold_changes(events: DataFrame, mode: str = RAW) -> DataFrame:
    """Documents left by a batch of ``events(seq, kind, path, …)`` applied in order.

    The last write of each path lives unless a later removal names a prefix of it, so
    one pass over sets replaces the one-by-one replay.
    """
    check_mode(mode)
    writes = latest(events.filter(F.col("kind").isin(CREATE, MODIFY)).drop("kind"))
    gone = (match_prefixes(writes.select("path", "seq"), removals(events, mode), mode)
            .filter("del_seq > seq").select("path").distinct())
    return writes.join(gone, "path", "left_anti")


def apply_changes(base: DataFrame, events: DataFrame, mode: str = RAW) -> DataFrame:
    """``base`` after the events: folded writes replace, removals take the rest."""
    live = fold_changes(events, mode)
    written = events.filter(F.col("kind").isin(CREATE, MODIFY)).select("path")
    removed = match_prefixes(base.select("path"), removals(events, mode), mode).select("path")
    touched = written.unionByName(removed).distinct()
    return (base.join(touched, "path", "left_anti")
            .unionByName(live.select(*base.columns)))


def snapshot_diff(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """``(path, kind)`` between two listings; ``by`` are the columns whose change counts."""
    left = old.select("path", F.struct(*by).alias("was"))
    right = new.select("path", F.struct(*by).alias("now"))
    kind = (F.when(F.col("was").isNull(), CREATE).when(F.col("now").isNull(), DELETE)
            .when(~F.col("was").eqNullSafe(F.col("now")), MODIFY))
    return (left.join(right, "path", "full_outer").select("path", kind.alias("kind"))
            .filter("kind is not null"))


__all__ = ["CREATE", "MODIFY", "DELETE", "OVERFLOW", "RAW", "SEGMENT", "change_counts",
           "events_in_roots", "deaths_of_roots", "events_while_alive", "fold_changes", "apply_changes", "snapshot_diff"]
