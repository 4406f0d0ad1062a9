"""Benchmark decontamination: short test items found inside long documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, broadcast_within, materialize
from .common import (LOWEST, WORD, Words, doubled_names, id_and_text, settle, signed,
                     small_batches)

SHINGLE = 5
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def needed(shingles: int, num: int, den: int) -> int:
    return -(-num * shingles // den)


def shingle_names(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Name and text number of every shingle; a text with fewer words is one shingle."""
    counts, names = words.counts, words.names
    begin = np.cumsum(counts) - counts
    each = np.maximum(counts - width + 1, (counts > 0).astype(np.int64))
    row = np.repeat(np.arange(len(counts)), each)
    place = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    out = np.zeros(len(row), dtype=np.uint64)
    whole = counts[row] >= width
    out[whole] = settle(doubled_names(names, width)[(begin[row] + place)[whole]])
    short = np.flatnonzero(~whole)
    for size in range(1, width):
        of = short[counts[row[short]] == size]
        out[of] = sequence_names(names, begin[row[of]], size)
    return out, row


def sequence_names(names: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """Names of ``size`` words from each of ``begin`` on, other than those of full shingles."""
    value = np.full(len(begin), size, dtype=np.uint64)
    for k in range(size):
        value = settle(value * np.uint64(3) + names[begin + k])
    return value


def inner_names(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Name and text number of every sequence of ``size`` words within the texts."""
    counts = words.counts
    each = np.maximum(counts - size + 1, 0)
    row = np.repeat(np.arange(len(counts)), each)
    begin = np.arange(len(row)) + np.repeat(np.cumsum(counts) - counts - np.cumsum(each) + each, each)
    return sequence_names(words.names, begin, size), row


def distinct_shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct names by text: names and text numbers, sorted by text, then name."""
    names, row = shingle_names(words, width)
    order = np.lexsort((names, row))
    names, row = names[order], row[order]
    new = np.ones(len(names), dtype=bool)
    new[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
    return names[new], row[new]


def spelled(text: str, width: int = SHINGLE) -> set[tuple[str, ...]]:
    words = WORD.findall(text.translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def item_signatures(items: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``part, item_id, name``: the least names of each item's shingles.

    Items are partitioned by size: ``part`` is the greatest power of two of shingles reached, or
    minus the number of words where an item has fewer than ``width``. An item of q shingles of
    which ``need`` must be found may miss q - need, so of its q - need + 1 least names one is in
    every document that contains it: the search loses nothing.
    """
    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = Words(b.column("text"), lower=True)
            names, row = distinct_shingles(words, width)
            size = np.bincount(row, minlength=b.num_rows)
            first = np.cumsum(size) - size
            place = np.arange(len(row)) - first[row]
            keep = place <= (size - (-(-num * size // den)))[row]
            item = np.asarray(b.column("item_id").to_numpy(zero_copy_only=False))[row[keep]]
            part = np.where(words.counts < width, -words.counts,
                            np.log2(np.maximum(size, 1)).astype(np.int64)).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "part": part[row[keep]],
                "item_id": pa.array(item.astype(np.int64)), "name": signed(names[keep].copy())})

    return items.mapInArrow(least, "part int, item_id long, name long")


def contained_items(docs: DataFrame, items: DataFrame, width: int = SHINGLE, num: int = 80,
                    den: int = 100) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment`` of items found in documents.

    An item is found if num/den or more of its distinct shingles of ``width`` words (ASCII lower
    case) are in the document; an item of fewer words is one shingle, found wherever the document
    has these words in a row. Candidates share one of the item's least shingle names; a document
    hands over only names up to the largest of the partitions whose items are small enough to be
    found in it, and shorter sequences only at the lengths that items have. Each candidate is
    checked on its shingles as words. Null and empty texts and items have no shingles and are never found; a null id of a
    document stays null, an item without an id is left out; rows that repeat an id give the best
    of their rows; extra columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = (items.filter("item_id IS NOT NULL")
             .select(F.col("item_id").cast("long").alias("item_id"),
                     F.coalesce(F.col("text"), F.lit("")).alias("text")))
    marks = materialize(item_signatures(known, width, num, den), "item-signatures")
    parts = marks.groupBy("part").agg(F.max(F.col("name").bitwiseXOR(F.lit(LOWEST))).alias("top"))
    # one row for a power of two; names are unsigned, with the sign bit turned they compare as such
    tops = {r["part"]: (r["top"] & (2 ** 64 - 1)) ^ (1 << 63) for r in parts.collect()}
    n_marks = marks.count()
    short = {-part: np.uint64(top) for part, top in tops.items() if part < 0}
    sizes = sorted(part for part in tops if part >= 0)
    least = np.array([needed(2 ** part, num, den) for part in sizes], dtype=np.int64)
    limits = np.maximum.accumulate(np.array([tops[part] for part in sizes], dtype=np.uint64))
    source = id_and_text(docs).select(F.coalesce("doc_id", F.lit(LOWEST)).alias("doc_id"), "text")

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = Words(b.column("text"), lower=True)
            ids = b.column("doc_id").to_numpy()
            # how many of the size classes a text's shingles are enough for
            fits = np.searchsorted(least, words.counts - width + 1, side="right")
            if len(limits):
                found, row = shingle_names(words, width)
                low = (fits[row] > 0) & (found <= limits[fits[row] - 1])
                yield pa.RecordBatch.from_pydict({"doc_id": ids[row[low]], "name": signed(found[low])})
            for size, limit in short.items():
                found, row = inner_names(words, size)
                low = found <= limit
                yield pa.RecordBatch.from_pydict({"doc_id": ids[row[low]], "name": signed(found[low])})

    hits = (source.mapInArrow(names, "doc_id long, name long")
            .join(broadcast_within(marks, n_marks), "name").select("doc_id", "item_id"))
    pairs = materialize(hits.groupBy("doc_id", "item_id").count(), "contained-candidates")
    n_pairs, n_items = pairs.count(), known.count()
    wanted = broadcast_within(pairs.select("doc_id").distinct(), n_pairs, BROADCAST_ROWS // 10)
    texts = source.join(wanted, "doc_id", "left_semi")
    asked = (pairs.select("doc_id", "item_id")
             .join(broadcast_within(known.withColumnRenamed("text", "item"), n_items,
                                    BROADCAST_ROWS // 100), "item_id"))
    checked = texts.join(asked, "doc_id")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, known = None, {}
        for b in batches:
            out = []
            for doc, text, item_id, item in zip(*(b.column(c).to_pylist() for c in (
                    "doc_id", "text", "item_id", "item")), strict=True):
                if text is not last_text and text != last_text:
                    last_text, known = text, {}
                own = spelled(item, width)
                size = len(next(iter(own), ()))
                if size not in known:
                    known[size] = spelled(text, size) if size else set()
                shared = len(own & known[size])
                if own and den * shared >= num * len(own):
                    out.append((doc, item_id, len(own), shared))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_pydict({
                n: pa.array(c, pa.int64()) for n, c in
                zip(("doc_id", "item_id", "n_item", "n_shared"), columns, strict=True)})

    return (checked.mapInArrow(check, "doc_id long, item_id long, n_item long, n_shared long")
            .groupBy("doc_id", "item_id", "n_item").agg(F.max("n_shared").alias("n_shared"))
            .select(F.when(F.col("doc_id") != LOWEST, F.col("doc_id")).alias("doc_id"), "item_id",
                    "n_item", "n_shared",
                    (F.col("n_shared") / F.col("n_item")).alias("containment")))


SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark),
sizes AS (SELECT DISTINCT least(len(w), 5) AS n FROM words WHERE kind = 'b' AND len(w) > 0),
shingles AS (
  SELECT DISTINCT kind, id, n, unnest(list_transform(range(1, len(w) - n + 2),
         lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s
  FROM words JOIN sizes ON len(w) >= n AND (kind = 'd' OR n = least(len(w), 5))),
items AS (SELECT id, n, s, count(*) OVER (PARTITION BY id) AS n_item FROM shingles
          WHERE kind = 'b')
SELECT d.id AS doc_id, i.id AS item_id, n_item, count(*) AS n_shared,
       count(*)::DOUBLE / n_item AS containment
FROM items i JOIN shingles d ON d.kind = 'd' AND d.n = i.n AND d.s = i.s
GROUP BY d.id, i.id, n_item HAVING 100 * count(*) >= 80 * n_item
"""
