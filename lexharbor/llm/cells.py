"""Vector codes by memoised grid cells: each part of a vector gets the number of its nearest entry.

The vectors are whole numbers, cut into equal parts, and every part has a codebook learned in a
few rounds over all vectors. A task hashes the coarse grid cell of each part. For a cell seen first
it bounds every entry's distance over the cell's box from below and above, and remembers the entries
whose least distance is within the smallest greatest distance; only those are evaluated exactly for
the cell's vectors. No entry dominated across the box can be nearest in it, so codes are exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexharbor.session import BROADCAST_ROWS, broadcast_within, count_up_to, materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Scaled components beyond this count as this; sums over any table then fit 38 digits.
LARGEST = 10 ** 24
# Cells remembered by a task for one part; beyond that it forgets all and goes on.
MEMO_CELLS = 20_000
# Vectors evaluated at once.
CHUNK = 2048
# Cells whose bounds are added up at once, to stay within a core's cache.
BLOCK = 256
LONG_MAX = 2 ** 63 - 1
CODES = "vec_id long, code string, error long"
SUMS = "slot int, total decimal(38,0)"


def kept_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, embedding, label`` of the vectors without null or non-finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label").filter(
        F.col("embedding").isNotNull() & finite)


def whole_numbers(column: pa.Array, width: int, scale: int, wide: bool) -> np.ndarray:
    """Vectors as rows of ``floor(scale * x)``, ended by zeros up to ``width``; exact."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    at = np.flatnonzero((np.arange(width) < sizes[:, None]).ravel())
    if wide:
        out = np.zeros(len(sizes) * width, dtype=object)
        scaled = (int(x) * scale if abs(x) > 2 ** 52 else math.floor(x * scale)
                  for x in flat.tolist())
        out[at] = [max(-LARGEST, min(LARGEST, x)) for x in scaled]
    else:
        out = np.zeros(len(sizes) * width, dtype=np.int64)
        out[at] = np.floor(flat * scale)
    return out.reshape(len(sizes), width)


class Codebook:
    """Entries of one part position, with the memo of cells of the task that uses it."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        spread = float(np.std(entries.astype(float))) if entries.size else 0.0
        # a cell is a quarter as wide as entries differ in a component
        self.width = max(1, int(spread / 4)) if math.isfinite(spread) else 1
        self.memo: dict[bytes | tuple, np.ndarray] = {}

    def _bounds(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared distance of every entry from every cell's box."""
        tables = []
        for d in range(cells.shape[1]):
            places, which = np.unique(cells[:, d], return_inverse=True)
            low = (places * self.width)[:, None]
            high = low + (self.width - 1)
            entry = self.entries[None, :, d]
            outside = np.maximum(np.maximum(low - entry, entry - high), 0)
            across = np.maximum(np.abs(entry - low), np.abs(high - entry))
            tables.append((which, outside * outside, across * across))
        kind = cells.dtype
        if kind != object and sum(int(most.max()) for _, _, most in tables) < 2 ** 31:
            kind = np.int32
        least = np.zeros((len(cells), len(self.entries)), kind)
        most = np.zeros_like(least)
        for which, low, high in tables:
            low, high = low.astype(kind, copy=False), high.astype(kind, copy=False)
            for a in range(0, len(cells), BLOCK):
                mine = which[a:a + BLOCK]
                least[a:a + BLOCK] += low[mine]
                most[a:a + BLOCK] += high[mine]
        return least, most

    def _candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell the entries that no other entry dominates across its box."""
        wide = cells.dtype == object
        keys = [tuple(c) for c in cells] if wide else [c.tobytes() for c in cells]
        new = [i for i, key in enumerate(keys) if key not in self.memo]
        if len(self.memo) + len(new) > MEMO_CELLS:
            self.memo.clear()
            new = list(range(len(keys)))
        if new:
            least, most = self._bounds(cells[new])
            near = least <= most.min(axis=1)[:, None]
            row, entry = np.nonzero(near)
            cuts = np.cumsum(np.bincount(row, minlength=len(new)))[:-1]
            for i, found in zip(new, np.split(entry.astype(np.int16), cuts), strict=True):
                self.memo[keys[i]] = found
        return [self.memo[key] for key in keys]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry (the lower of equals) and its squared distance."""
        number = np.zeros(len(vectors), np.int64)
        distance = np.zeros(len(vectors), vectors.dtype)
        for a in range(0, len(vectors) if vectors.shape[1] else 0, CHUNK):
            mine = vectors[a:a + CHUNK]
            cells = mine // self.width
            if cells.dtype == object:
                at: dict[tuple, int] = {}
                which = np.array([at.setdefault(tuple(c), len(at)) for c in cells])
                cells = np.array([list(c) for c in at], dtype=object)
            else:
                cells, which = np.unique(cells, axis=0, return_inverse=True)
            found = self._candidates(np.ascontiguousarray(cells))
            sizes = np.array([len(f) for f in found])[which.ravel()]
            entry = np.concatenate([found[i] for i in which.ravel()]).astype(np.int64)
            off = mine[np.repeat(np.arange(len(mine)), sizes)] - self.entries[entry]
            exact = (off * off).sum(axis=1)
            starts = np.cumsum(sizes) - sizes
            best = np.minimum.reduceat(exact, starts)
            first = np.flatnonzero(exact == np.repeat(best, sizes))
            owner = np.repeat(np.arange(len(mine)), sizes)[first]
            number[a + owner[::-1]] = entry[first[::-1]]
            distance[a:a + CHUNK] = best
        return number, distance


def nearest_entries(batch: pa.RecordBatch, books: list[Codebook], scale: int):
    """For each part of a batch: its rows, entry numbers and squared distances."""
    width = sum(b.entries.shape[1] for b in books)
    wide = any(b.entries.dtype == object for b in books)
    vectors, step = whole_numbers(batch.column("embedding"), width, scale, wide), width // len(books)
    for p, book in enumerate(books):
        mine = vectors[:, p * step:(p + 1) * step]
        yield p, mine, *book.nearest(mine)


def adding(entries: list[np.ndarray], scale: int):
    """Task: how many parts chose each entry and the sums of their components, by slot."""
    per_entry = entries[0].shape[1] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(e) for e in entries]
        total = np.zeros((len(books), len(entries[0]), per_entry), dtype=object)
        for batch in batches:
            for p, mine, number, _ in nearest_entries(batch, books, scale):
                order = np.argsort(number, kind="stable")
                chosen, first = np.unique(number[order], return_index=True)
                if len(chosen):
                    ones = np.ones((len(mine), 1), mine.dtype)
                    sums = np.add.reduceat(np.hstack([ones, mine])[order], first, axis=0)
                    total[p, chosen] += sums.astype(object)
        p, e, d = np.nonzero(np.broadcast_to(total[:, :, :1] != 0, total.shape))
        slots = (p * len(entries[0]) + e) * per_entry + d
        yield pa.RecordBatch.from_pydict({
            "slot": pa.array(slots, pa.int32()),
            "total": pa.array([Decimal(int(x)) for x in total[p, e, d]], pa.decimal128(38, 0))})
    return run


def coding(entries: list[np.ndarray], scale: int):
    """Task: code and error of each vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(e) for e in entries]
        for batch in batches:
            codes, error = [""] * len(batch), np.zeros(len(batch), object)
            for _, _, number, distance in nearest_entries(batch, books, scale):
                codes = [f"{c}{n:02x}" for c, n in zip(codes, number.tolist(), strict=True)]
                error += distance.astype(object)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"), "code": pa.array(codes, pa.string()),
                "error": pa.array([min(int(e), LONG_MAX) for e in error], pa.int64()),
                "label": batch.column("label")})
    return run


def first_vectors(vectors: DataFrame, size: int) -> list[list[float]]:
    """The vectors of the ``size`` smallest ids; equal ids by a hash of the vector, null ids last.

    Ids and hashes alone are ranked, first within groups of partitions, so no task takes in a row
    of every partition's vectors; then at most ``size`` vectors are read.
    """
    keys = vectors.select("vec_id", F.xxhash64("embedding").alias("hash"),
                          F.pmod(F.spark_partition_id(), F.lit(64)).alias("g"))
    order = [F.asc_nulls_last("vec_id"), "hash"]
    by_group = Window.partitionBy("g").orderBy(*order)
    least = [(r["vec_id"], r["hash"]) for r in
             keys.withColumn("n", F.row_number().over(by_group)).filter(F.col("n") <= size)
             .orderBy(*order).limit(size).collect()]
    if not least:
        return []
    spark = vectors.sparkSession
    wanted = F.broadcast(spark.createDataFrame(sorted(set(least), key=str), "w long, h long"))
    same = F.col("vec_id").eqNullSafe(F.col("w")) & (F.xxhash64("embedding") == F.col("h"))
    found = (vectors.join(wanted, same).groupBy("vec_id", "h")
             .agg(F.min("embedding").alias("embedding")).collect())
    at = {(r["vec_id"], r["h"]): list(r["embedding"]) for r in found}
    return [at[key] for key in least]


def learn(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          scale: int = SCALE) -> list[np.ndarray]:
    """Codebooks of the part positions: rows of whole numbers, learned over all vectors.

    They start as the parts of the first vectors by id. A round sums the parts nearest to each
    entry in the tasks, adds up by slot in Spark, and the driver holds the codebooks alone.
    """
    seen = vectors.agg(F.max(F.size("embedding")).alias("width"), F.max(F.greatest(
        F.abs(F.array_max("embedding")), F.abs(F.array_min("embedding")))).alias("most")).first()
    step = -(-max(seen["width"] or 0, 0) // parts)
    reach = 2 * (float(seen["most"] or 0.0) * scale + 1)
    wide = reach * reach * max(step, 1) * parts >= 2.0 ** 62
    start = pa.array(first_vectors(vectors, entries), pa.list_(pa.float64()))
    first = whole_numbers(start, step * parts, scale, wide)
    books = [first[:, p * step:(p + 1) * step] for p in range(parts)]
    if not len(first):
        return books
    for _ in range(rounds):
        partial = vectors.select("embedding").mapInArrow(adding(books, scale), SUMS)
        added = dict(partial.groupBy("slot").agg(F.sum("total").alias("total")).collect())
        after = []
        for p, book in enumerate(books):
            new = book.copy()
            for e in range(len(book)):
                slot = (p * len(book) + e) * (step + 1)
                n = int(added.get(slot, 0))
                if n:
                    new[e] = [int(added[slot + 1 + d]) // n for d in range(step)]
            after.append(new)
        books = after
    return books


def quantize(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for ``rows(vec_id, embedding, label)``.

    Vectors that are null or hold null or non-finite components are left out; other columns of
    ``rows`` are not read. Vectors shorter than the longest read as ended by zeros, as does the
    last part if the parts cannot be equal. Repeated ids keep all their rows; null ids come last.
    Components whose scaled value is beyond 10**24 count as that, and errors stop at the greatest
    long. An empty table, or one without a kept vector, gives no rows. Null labels are one label.
    """
    vectors = kept_vectors(rows)
    books = learn(vectors, parts, entries, rounds, scale)
    text = ",".join(str(int(x)) for book in books for x in book.ravel())
    digest = hashlib.sha256(text.encode()).hexdigest()
    label = rows.schema["label"].dataType.simpleString()
    coded = materialize(vectors.mapInArrow(coding(books, scale), f"{CODES}, label {label}"), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("label").agg(
        F.least(total, F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long").alias("label_error"))
    sums = sums.withColumnRenamed("label", "of")
    sums = broadcast_within(sums, count_up_to(sums, BROADCAST_ROWS))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL for vectors of equal length, a multiple of ``parts``, with distinct ids."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS e,
         list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT vec_id, label, e, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x
  FROM kept, range({parts}) t(p)),
book0 AS MATERIALIZED (SELECT p, e, x AS c, list_inner_product(x, x) AS cc FROM cut
  WHERE e < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
  SELECT vec_id, p, min({{'d': cc - 2 * list_inner_product(x, c), 'e': b.e}}) AS best
  FROM cut JOIN book{r} b USING (p) GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""mean{r} AS MATERIALIZED (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, best.e AS e, i, floor(sum(x[i]) / count(*)) AS m
    FROM near{r} JOIN cut USING (vec_id, p), range(1, len(x) + 1) t(i) GROUP BY ALL)
  GROUP BY p, e),
book{r + 1} AS MATERIALIZED (
  SELECT p, e, c, list_inner_product(c, c) AS cc FROM (
    SELECT p, e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m USING (p, e)))""")
    return "WITH " + ",\n".join(steps) + f""",
coded AS (
  SELECT vec_id, any_value(label) AS label,
         string_agg(printf('%02x', best.e::BIGINT), '' ORDER BY p) AS code,
         sum(best.d + list_inner_product(x, x))::BIGINT AS error
  FROM near{rounds} JOIN cut USING (vec_id, p) GROUP BY vec_id),
named AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ','
                           ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error,
       (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded, named"""
