"""The list of registered roots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def from_lines(spark: SparkSession, file: str) -> DataFrame:
    """``roots(seq, path)`` from a text file with one path per line."""
    lines = spark.read.text(file).withColumn("seq", F.monotonically_increasing_id())
    return lines.filter(F.trim("value") != "").select("seq", F.col("value").alias("path"))


def listed(roots: DataFrame) -> DataFrame:
    """Roots in the order they were registered."""
    return roots.select("seq", "path").orderBy("seq")


def readable(spark: SparkSession, roots: DataFrame) -> list[str]:
    """Check that every root can be read before any is reindexed.

    Roots are typed in by people, so their number is small; the first that cannot be
    read fails the whole call and nothing has changed yet.
    """
    paths = [r["path"] for r in listed(roots).collect()]
    for path in paths:
        try:
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        except Exception as missing:
            raise ValueError(f"cannot read the root {path}") from missing
    return paths
