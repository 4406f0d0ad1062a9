"""Session defaults, the shared scratch folder and broadcast checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side may be broadcast only when it provably has no more rows than this.
BROADCAST_ROWS = 500_000

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches are counted in rows; documents are big rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", memory: str = "16g", partitions: int = 8,
                  name: str = "lexharbor", **extra: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {**DEFAULTS, "spark.driver.memory": memory,
                "spark.sql.shuffle.partitions": str(partitions), **extra}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local folder would lose data with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="lexharbor-")
    spark.conf.set("spark.checkpoint.dir", made)
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    optimizer true sizes for whatever joins the result next.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def count_up_to(df: DataFrame, limit: int) -> int:
    """Row count, counting no further than ``limit + 1``."""
    return df.limit(limit + 1).count()


def broadcast_within(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint if ``rows``, a proven bound on ``df``, is small; else none.

    Without the hint the join is left to adaptive execution, which shuffles and
    splits skewed keys.
    """
    return F.broadcast(df) if rows <= limit else df


def least_level(table: DataFrame, weight: str, limit: int = BROADCAST_ROWS) -> int | None:
    """The least power of two that the ``weight`` of no more than ``limit`` rows reaches; ``None``
    if more rows have the greatest ones."""
    power = F.floor(F.log2(weight)).cast("int")
    sizes = table.groupBy(power.alias("power")).count().collect()  # a row for each power of two
    least, held = None, 0
    for row in sorted(sizes, key=lambda r: -r["power"]):
        held += row["count"]
        if held > limit:
            break
        least = 1 << row["power"]
    return least


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    """Session settings for a while; what was set before is set again."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
