"""Token ids in seekable zstandard shards, and a reader that opens only what it is asked for.

A shard holds documents in ascending ``doc_id`` order:

* independent zstandard frames, each with the ids of whole consecutive documents, little-endian,
  two bytes an id if the vocabulary allows, else four;
* one skippable frame (magic 0x184D2A50) with the document index: the width of an id, then
  ``doc_id int64, frame uint32, n_tokens uint32`` for each document;
* one skippable frame (magic 0x184D2A5E) with the public seek table: compressed size, plain size
  and checksum (low 32 bits of XXH64 of the plain bytes) of each frame, then the number of frames,
  a descriptor byte with the checksum bit, and the magic 0x8F92EAB1.

A reader takes the tail, then the index, then the frames of the documents it wants.
"""

from __future__ import annotations

import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .common import LOWEST, Words, id_and_text, order_ids, small_batches, total_bytes

# Fixed values of the public seekable format.
SKIP_INDEX, SKIP_SEEK, SEEK_MAGIC, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
FRAME_BYTES = 256 << 10
SHARD_BYTES = 32 << 20
# Pieces whose ids a Python worker remembers; beyond that it starts afresh.
KNOWN_PIECES = 3_000_000
LINE = 200
END_ID = 2
ENTRY = np.dtype([("doc_id", "<i8"), ("frame", "<u4"), ("n", "<u4")])


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# Kinds of bytes between which this kind of tokenizer always starts a new piece: ASCII letters,
# digits and other signs. A quote may begin a contraction and "<" a special token: such words stay
# whole. Bytes beyond ASCII belong to no kind, so nothing is cut at them.
KINDS = np.zeros(256, dtype=np.int8)
KINDS[33:127], KINDS[48:58], KINDS[65:91], KINDS[97:123] = 3, 2, 1, 1
WHOLE = np.zeros(256, dtype=bool)
WHOLE[[ord("'"), ord("<")]] = True


class Encoder:
    """Ids of many texts; each distinct piece of a text is encoded once by the library.

    White space, and a change between ASCII letters, digits and signs, ends every token of this
    kind of tokenizer, which also ignores case, so the ids of a text are those of its pieces one
    after another. ``by_piece`` False encodes texts whole, for tokenizers of other kinds. What is
    known is held in flat arrays: names in order, a check (length and first bytes), ids.
    """

    def __init__(self, path: str, by_piece: bool = True):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.by_piece = by_piece
        vocabulary = self.tokenizer.get_vocab()
        # added tokens may carry ids above the vocabulary's count
        top = max(vocabulary.values())
        self.width = 2 if top < 1 << 16 else 4
        # ids of tokens that end a word, as this kind of vocabulary marks them
        self.last = np.zeros(top + 1, dtype=bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.kind = np.dtype(f"<u{self.width}")
        self.forget()

    def forget(self) -> None:
        self.names = np.zeros(0, dtype=np.uint64)
        self.checks = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int32)
        self.pool = np.zeros(0, dtype=self.kind)

    def _find(self, names: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Places of the pieces among the known ones, -1 for others."""
        if not len(self.names):
            return np.full(len(names), -1)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return np.where((self.names[at] == names) & (self.checks[at] == checks), at, -1)

    def _learn(self, words: Words, new: np.ndarray, checks: np.ndarray) -> None:
        _, once = np.unique(words.names[new], return_index=True)
        new = new[once]
        raw = words.raw.tobytes()
        ids, at, size = self._encoded([raw[a:b].decode() for a, b in zip(
            words.starts[new].tolist(), words.ends[new].tolist(), strict=True)])
        at += len(self.pool)
        self.pool = np.concatenate([self.pool, ids])
        names = np.concatenate([self.names, words.names[new]])
        order = np.argsort(names, kind="stable")
        self.names = names[order]
        self.checks = np.concatenate([self.checks, checks[new]])[order]
        self.at = np.concatenate([self.at, at])[order]
        self.size = np.concatenate([self.size, size])[order]

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces, and where each piece's begin and how many they are.

        Plain lower-case words go to the library many to a text.
        """
        low = [p.lower() for p in pieces]
        plain = [k for k, p in enumerate(low)
                 if p.isalpha() and (p.isascii() or (unicodedata.is_normalized("NFC", p)
                                                     and p == p.casefold()))]
        at, size = np.zeros(len(pieces), np.int64), np.full(len(pieces), -1, np.int32)
        parts, have = [], 0
        lines = [plain[i:i + LINE] for i in range(0, len(plain), LINE)]
        for line, e in zip(lines, self.tokenizer.encode_batch_fast(
                [" ".join([low[k] for k in line]) for line in lines],
                add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype=self.kind)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(line):
                continue
            each = np.diff(ends, prepend=0)
            at[line], size[line] = have + ends - each, each
            parts.append(ids)
            have += len(parts[-1])
        rest = np.flatnonzero(size < 0).tolist()
        for k, e in zip(rest, self.tokenizer.encode_batch_fast(
                [pieces[k] for k in rest], add_special_tokens=False), strict=True):
            at[k], size[k] = have, len(e.ids)
            parts.append(np.array(e.ids, dtype=self.kind))
            have += len(parts[-1])
        return np.concatenate([*parts, np.zeros(0, self.kind)]), at, size

    def __call__(self, column, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by ``end_id``, and how many each text has."""
        if not self.by_piece:
            return self._joined([e.ids for e in self.tokenizer.encode_batch(
                column.to_pylist(), add_special_tokens=False)], end_id)
        words = Words(column, lower=True, split=KINDS, whole=WHOLE)
        if len(self.names) > KNOWN_PIECES:
            self.forget()
        padded = np.concatenate([words.raw, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(words.raw) + 1,), dtype="<u8", buffer=padded, strides=(1,))
        length = words.ends - words.starts
        keep = np.uint64(0xFFFFFFFFFFFFFFFF) >> (64 - 8 * np.minimum(length, 8)).astype(np.uint64)
        # letters differ by bit 32 in case only
        checks = ((eight[words.starts] & keep) | np.uint64(0x2020202020202020)) \
            + (length.astype(np.uint64) << np.uint64(56))
        place = self._find(words.names, checks)
        if (place < 0).any():
            self._learn(words, np.flatnonzero(place < 0), checks)
            place = self._find(words.names, checks)
            if (place < 0).any():   # two pieces with one name: leave such a batch to the library
                return self._joined([e.ids for e in self.tokenizer.encode_batch(
                    column.to_pylist(), add_special_tokens=False)], end_id)
        ends = np.cumsum(words.counts)
        size = np.insert(self.size[place], ends, 1)
        at = np.insert(self.at[place], ends, len(self.pool))
        stop = np.cumsum(size)
        take = np.arange(stop[-1] if len(stop) else 0) + np.repeat(at - (stop - size), size)
        pool = np.append(self.pool, np.array([end_id], dtype=self.kind))
        return pool[take], np.diff(stop[ends + np.arange(len(ends))], prepend=0)

    def _joined(self, lists, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        flat = np.array([i for ids in lists for i in (*ids, end_id)], dtype=self.kind)
        return flat, np.array([len(ids) + 1 for ids in lists], dtype=np.int64)


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder_for(path: str, by_piece: bool) -> Encoder:
    """One encoder for all tasks of a Python worker, so that what it knows is kept."""
    if (path, by_piece) not in _encoders:
        _encoders[path, by_piece] = Encoder(path, by_piece)
    return _encoders[path, by_piece]


def write_shard(sink, chunks: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]],
                width: int) -> tuple[int, int]:
    """Write (doc ids, ids, counts) chunks as one shard; returns documents and tokens."""
    packer = zstandard.ZstdCompressor(level=3, write_content_size=True)
    seek, index, n_tokens = [], [], 0
    held: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        plain = b"".join(held)
        packed = packer.compress(plain)
        sink.write(packed)
        seek.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        held, size = [], 0

    for ids, tokens, counts in chunks:
        stops = np.cumsum(counts)
        for doc, a, b in zip(ids.tolist(), (stops - counts).tolist(), stops.tolist(), strict=True):
            part = tokens[a:b].tobytes()
            if size and size + len(part) > FRAME_BYTES:
                flush()
            index.append((doc, len(seek), b - a))
            held.append(part)
            size += len(part)
            n_tokens += b - a
    if held:
        flush()
    table = struct.pack("<B", width) + np.array(index, dtype=ENTRY).tobytes()
    sink.write(struct.pack("<II", SKIP_INDEX, len(table)) + table)
    rows = b"".join(struct.pack("<III", *s) for s in seek)
    tail = rows + struct.pack("<IBI", len(seek), CHECKSUMS, SEEK_MAGIC)
    sink.write(struct.pack("<II", SKIP_SEEK, len(tail)) + tail)
    return len(index), n_tokens


class Shard:
    """Random access to one shard in any random-access file."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        frames, _, magic = struct.unpack("<IBI", source.read_at(9, end - 9))
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table at the end of the shard")
        head = end - 9 - 12 * frames - 8
        self.seek = np.frombuffer(source.read_at(12 * frames, head + 8), dtype="<u4").reshape(-1, 3)
        self.at = np.concatenate([[0], np.cumsum(self.seek[:, 0].astype(np.int64))])
        table = source.read_at(head - int(self.at[-1]), int(self.at[-1]))
        self.kind = np.dtype(f"<u{table[8]}")
        self.index = np.frombuffer(table[9:], dtype=ENTRY)

    def frame(self, k: int) -> np.ndarray:
        packed, plain, check = (int(x) for x in self.seek[k])
        data = zstandard.ZstdDecompressor().decompress(
            self.source.read_at(packed, int(self.at[k])), max_output_size=plain)
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} does not match its checksum")
        return np.frombuffer(data, dtype=self.kind)

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(doc_id, ids) in order; with ``wanted`` only the frames of those documents are read."""
        last, ids, at = -1, None, 0
        for doc, frame, n in self.index.tolist():
            if frame != last:
                last, at, ids = frame, 0, None
            if wanted is None or doc in wanted:
                if ids is None:
                    ids = self.frame(frame)
                yield doc, ids[at:at + n]
            at += n


def open_shard(path: str) -> Shard:
    where, inner = pafs.FileSystem.from_uri(path)
    return Shard(where.open_input_file(inner))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID,
                 by_piece: bool = True, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write all documents as shards under ``folder``; returns ``shard, path, n_docs, n_tokens``.

    ``shard`` counts in ascending ``doc_id`` order (null ids first, equal ids by text). Documents
    are dealt into shards by ranges of ids. A task writes under a name of its own and the returned
    table, stored before use, names the files of the tasks that ended well, so a lost executor
    leaves no wrong rows. ``folder`` must be open to all executors. A null text is empty and gives
    the end id alone; an empty table gives no shards.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = tokenizer or default_tokenizer()
    source = id_and_text(docs)
    shards = max(1, -(-total_bytes(source) // shard_bytes))
    dealt = (source.repartitionByRange(int(shards), F.col("doc_id").asc_nulls_first())
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        lowest = None

        def chunks():
            nonlocal lowest
            for b in batches:
                if b.num_rows:
                    ids = order_ids(b.column("doc_id"))
                    lowest = int(ids[0]) if lowest is None else lowest
                    tokens, counts = encoder(b.column("text"), end_id)
                    yield ids, tokens, counts

        encoder = encoder_for(path, by_piece)
        where, inner = pafs.FileSystem.from_uri(folder)
        where.create_dir(inner, recursive=True)
        name = f"tokens-{uuid.uuid4().hex}.zst"
        with where.open_output_stream(f"{inner}/.{name}", compression=None) as sink:
            n_docs, n_tokens = write_shard(sink, chunks(), encoder.width)
        if n_docs:
            where.move(f"{inner}/.{name}", f"{inner}/{name}")
            yield pa.RecordBatch.from_pydict({
                "lowest": pa.array([lowest], pa.int64()), "path": [f"{folder}/{name}"],
                "n_docs": pa.array([n_docs], pa.int64()),
                "n_tokens": pa.array([n_tokens], pa.int64())})
        else:
            where.delete_file(f"{inner}/.{name}")

    written = materialize(dealt.mapInArrow(
        write, "lowest long, path string, n_docs long, n_tokens long"), "token-shards")
    # one row for each shard, so the order over all of them is a small matter
    return written.select((F.row_number().over(Window.orderBy("lowest")) - 1).alias("shard"),
                          "path", "n_docs", "n_tokens")


def read_tokens(manifest: DataFrame, ids: bool = False) -> DataFrame:
    """One row per stored document: ``doc_id, start, n_tokens, ids_crc32`` and, if asked, ``ids``.

    ``start`` counts the ids of all documents before it; the checksum is over the ids as
    little-endian 32-bit numbers. Every frame's own checksum is verified.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    shards = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist(),
                                  strict=True):
                rows: list[tuple] = []
                start = base
                for doc, found in open_shard(path).documents():
                    plain = found.astype("<u4")
                    rows.append((None if doc == LOWEST else doc, start, len(found),
                                 zlib.crc32(plain.tobytes()),
                                 plain.astype(np.int64) if ids else None))
                    start += len(found)
                    if len(rows) == 2000:
                        yield as_batch(rows)
                        rows = []
                if rows:
                    yield as_batch(rows)

    def as_batch(rows):
        columns = list(zip(*rows, strict=True))
        out = {n: pa.array(c, pa.int64()) for n, c in
               zip(("doc_id", "start", "n_tokens", "ids_crc32"), columns[:4], strict=True)}
        if ids:
            out["ids"] = pa.array(columns[4], pa.list_(pa.int64()))
        return pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return (based.repartition(shards, "path").select("path", "base")
            .mapInArrow(read, schema + (", ids array<long>" if ids else "")))


def tokenised(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write ``docs`` to a fresh shared folder and describe what is read back."""
    return read_tokens(write_tokens(docs, scratch_path(spark, "tokens")))
