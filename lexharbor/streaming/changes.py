"""Change events folded into a stored index by Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lexharbor.operators.changes import events_in_roots
from lexharbor.operators.prefixes import RAW
from lexharbor.plans.snapshot import Snapshots

EVENTS = "seq bigint, kind string, path string, lang string, title string, body string"


def change_stream(spark: SparkSession, folder: str, schema: str = EVENTS, glob: str | None = None,
                  files_per_batch: int | None = None) -> DataFrame:
    """A stream over a growing folder of Parquet change events."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


class Watch:
    """A running stream of changes; it ends by itself once no root is left to watch."""

    def __init__(self, query: StreamingQuery, nothing_left: Callable[[], bool]):
        self.query, self._nothing_left = query, nothing_left

    def wait(self, seconds: float | None = None, step: float = 0.5) -> bool:
        """Wait until the stream ends, or for so long; whether it has ended."""
        waited = 0.0
        while not self.query.awaitTermination(step):
            if self._nothing_left():
                # a micro-batch cannot stop its own query
                self.query.stop()
                return True
            waited += step
            if seconds is not None and waited >= seconds:
                return False
        return True

    def stop(self) -> None:
        self.query.stop()


def run_changes(stream: DataFrame, snapshots: Snapshots, checkpoint: str, mode: str = RAW,
                roots: DataFrame | None = None, watched: bool = False,
                listing: Callable[[], DataFrame] | None = None, **trigger) -> Watch:
    """Apply the events of the stream, one index version per micro-batch.

    A batch replayed after a failure has the id of one already applied and changes nothing.
    ``trigger`` are arguments of the stream's trigger: without any, all events now there are taken
    and the stream ends; ``processingTime="10 seconds"`` goes on. Events outside the given ``roots``
    are dropped. With ``watched``, the roots are those stored with the index, read anew in every
    micro-batch, so one registered meanwhile is taken up; a root that is deleted leaves the list
    with that batch, and the stream ends when none is left. Overflow means events were lost:
    the same micro-batch then compares the index with ``listing()``, the documents as they are, and
    applies the differences.
    """
    left = {"roots": True}

    def one_batch(events: DataFrame, batch_id: int) -> None:
        wanted = events if roots is None else events_in_roots(events, roots, mode)
        snapshots.apply(wanted, mode, batch_id, watched, listing)
        if watched:
            left["roots"] = not snapshots.roots().isEmpty()

    query = (stream.writeStream.foreachBatch(one_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"availableNow": True})).start())
    return Watch(query, lambda: not left["roots"])
