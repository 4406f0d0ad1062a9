"""Path-prefix joins as equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexharbor.functions.text import ancestors_of, prefixes_of

RAW = "raw_prefix"
SEGMENT = "segment"


def check_mode(mode: str) -> None:
    if mode not in (RAW, SEGMENT):
        raise ValueError(f"mode must be {RAW!r} or {SEGMENT!r}, not {mode!r}")


def match_prefixes(rows: DataFrame, prefixes: DataFrame, mode: str = RAW,
                   text: str = "path", prefix: str = "prefix") -> DataFrame:
    """``rows`` joined to every row of ``prefixes`` that its ``text`` starts with.

    ``raw_prefix`` compares plain strings, so ``/c/a`` also matches ``/c/ab/x``;
    ``segment`` matches whole path segments. Each row emits its own prefixes, at the
    lengths that occur in ``prefixes`` or at the folder ends, and joins on equality:
    nothing compares every row with every prefix. The lengths are few (no more than
    the longest prefix has characters), whatever the size of either table.
    """
    check_mode(mode)
    if mode == SEGMENT:
        own = ancestors_of(F.col(text))
        right = prefixes.withColumn(prefix, F.regexp_replace(prefix, "(?<=.)/+$", ""))
    else:
        right = prefixes
        found = right.select(F.length(prefix).alias("n")).filter("n is not null").distinct()
        own = prefixes_of(F.col(text), sorted(r["n"] for r in found.collect()))
    return rows.withColumn(prefix, F.explode(own)).join(right, prefix)


def starts_within(path, root: str, mode: str = RAW):
    """Whether a path column lies under one given root."""
    check_mode(mode)
    if mode == RAW:
        return path.startswith(root)
    root = root.rstrip("/") or "/"
    return (path == root) | path.startswith(root if root == "/" else root + "/")
