"""Helpers shared by the operators: inputs, blocks of documents, hashed names of token strings."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

# Words are what white space of ASCII separates.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# Text held by one block of documents; Python tasks hold a few blocks' arrays at a time.
BLOCK_BYTES = 1 << 20
# Documents are big rows: so many rows and bytes go to Python in one Arrow batch.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20
LOWEST = -(2 ** 63)


def documents_of(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches are counted in rows; keep those of long texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text read as empty; other columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def total_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def in_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """``block, doc_id, text`` shuffled once by block; name bits.

    A block is about ``block_bytes`` of text, whatever the table's size, picked by a hash of id
    and text, so texts that share one id, or none, are spread. Several passes over the same blocks
    share the one shuffle within a query. The bits are those that keep names of so much text
    mostly apart.
    """
    size = total_bytes(docs)
    blocks = F.lit(max(1, -(-size // block_bytes)))
    wide = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), blocks).cast("int").alias("block"),
        "doc_id", "text").repartition(wide, "block")
    return dealt, min(63, max(size, 2).bit_length() + 8)


def written_round(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder; the shuffle files made for it go at once."""
    spark, name = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        return materialize(df, label)
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def texts_buffer(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of UTF-8 bytes, and the offsets of each text in it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64,
                            count=len(column) + 1, offset=column.offset * 8) \
        if len(column) else np.zeros(1, dtype=np.int64)
    data = column.buffers()[2] if len(column) else None
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


# Multipliers of the name hash: fixed odd numbers, any would do.
K1, K2, K3 = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F),
              np.uint64(0x165667B19E3779F9))
S32, S29 = np.uint64(32), np.uint64(29)


def pair_names(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of a pair of names: equal pairs get equal names wherever they occur."""
    out = a * K1
    out += b * K2
    out ^= out >> S32
    out *= K3
    return out


def settle(a: np.ndarray) -> np.ndarray:
    """Spread a name over all 64 bits."""
    out = a ^ (a >> S29)
    out *= K2
    out ^= out >> S32
    return out


def doubled_names(names: np.ndarray, width: int) -> np.ndarray:
    """Names of all strings of ``width`` symbols, by doubling: two halves name the whole.

    The result has one entry per start; the last ``width - 1`` starts have none.
    """
    at, have = names, 1
    while have < width and len(at):
        step = min(have, width - have)
        at = pair_names(at[:-step], at[step:]) if len(at) > step else at[:0]
        have += step
    return at


def byte_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 2 ** 64)
    out = []
    for b in (base, inverse):
        p = np.empty(n + 1, dtype=np.uint64)
        p[0], k = 1, 1
        while k <= n:
            m = min(k, n + 1 - k)
            p[k:k + m] = p[:m] * np.uint64(pow(b, k, 2 ** 64))
            k += m
        out.append(p)
    return out[0], out[1]


_BYTES = np.random.default_rng(20).integers(1, 2 ** 63, 256, dtype=np.uint64)
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, 9, 10, 11, 12, 13]] = True
# ASCII signs that are neither letters nor digits, for words without punctuation.
SIGNS = np.zeros(256, dtype=bool)
SIGNS[:128] = True
SIGNS[48:58] = SIGNS[65:91] = SIGNS[97:123] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of many texts: names, byte spans and how many each text has."""

    def __init__(self, column, lower: bool = False, gaps: np.ndarray = _GAP,
                 split: np.ndarray | None = None, whole: np.ndarray | None = None):
        """``split``: kinds of bytes, cut where one kind over 0 meets another; ``whole``: words
        with such a byte stay uncut and keep their case."""
        raw, offsets = texts_buffer(column)
        self.raw, self.offsets = raw, offsets
        gap = gaps[raw]
        first = ~gap
        last = first.copy()
        first[1:] &= gap[:-1]
        last[:-1] &= gap[1:]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(raw))]
        if len(inner):
            first[inner] = ~gap[inner]
            last[inner - 1] = ~gap[inner - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        table = _LOWER[raw] if lower else raw
        if split is not None:
            kind = split[raw]
            cut = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
            kept = np.flatnonzero(whole[raw])
            if len(kept):
                word = np.unique(np.searchsorted(self.starts, kept, side="right") - 1)
                for a, b in zip(self.starts[word].tolist(), self.ends[word].tolist(), strict=True):
                    cut[a:b - 1] = False
                    table[a:b] = raw[a:b]
            first[1:] |= cut & ~gap[1:] & ~gap[:-1]
            last[:-1] |= cut & ~gap[1:] & ~gap[:-1]
            self.starts = np.flatnonzero(first)
            self.ends = np.flatnonzero(last) + 1
        power, self.inverse = byte_powers(len(raw))
        self.sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[table] * power[:-1], out=self.sums[1:])
        self.names = self.named(self.starts, self.ends)
        self.counts = np.diff(np.searchsorted(self.starts, offsets))

    def named(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Names of byte strings of the texts."""
        names = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return settle(names + (end - start).astype(np.uint64) * K1)

    def heads(self, size: int) -> np.ndarray:
        """Names of the first ``size`` bytes of each word, of all of it if it is shorter."""
        return self.named(self.starts, np.minimum(self.starts + size, self.ends))


def in_sorted(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which values occur in ``keys``, which is sorted."""
    if not len(keys):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(keys, values)
    at[at == len(keys)] = 0
    return keys[at] == values


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def unsigned(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy().astype(np.int64, copy=False).view(np.uint64)


def order_ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Ids as numbers; a null id comes before all others."""
    return np.asarray(column.fill_null(LOWEST).to_numpy(), dtype=np.int64)


def back_to_ids(values: np.ndarray, column) -> pa.Array:
    return pa.array(values, pa.int64(), mask=np.asarray(column.is_null().to_numpy(zero_copy_only=False)))


def crc(text: str) -> int:
    return zlib.crc32(text.encode())
