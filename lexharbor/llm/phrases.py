"""Document fingerprints from Lempel-Ziv phrases."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import K1, LOWEST, byte_powers, id_and_text, order_ids, settle, small_batches, total_bytes

# Places of a signature; the least phrase hash of each is kept.
PLACES = 128
EMPTY = 1 << 16
RANGE_BYTES = 2 << 20
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"][0]) <= n:
        _powers["p"] = byte_powers(max(2 * n, 1 << 16))
    return _powers["p"]


class Phrases:
    """A text parsed into phrases, each the shortest string not yet in its dictionary.

    ``fork`` says after how many characters another text shares the parse so far.
    """

    def __init__(self):
        self.known: set[str] = set()
        self.ends: list[int] = []
        self.start = 0

    def fork(self) -> Phrases:
        other = Phrases()
        other.known, other.ends, other.start = self.known.copy(), self.ends.copy(), self.start
        return other

    def read(self, text: str, begin: int, end: int) -> Phrases:
        """Go on from the last phrase, with characters ``begin`` to ``end`` not looked at yet."""
        known, start = self.known, self.start
        learn, ended = known.add, self.ends.append
        for stop in range(begin + 1, end + 1):
            phrase = text[start:stop]
            if phrase not in known:
                learn(phrase)
                ended(stop)
                start = stop
        self.start = start
        return self

    def codes(self, text: str) -> np.ndarray:
        """The signature: for each place the code of its least phrase, or ``EMPTY``."""
        out = np.full(PLACES, EMPTY, dtype=np.uint32)
        if not text:
            return out
        ends = np.array(self.ends + ([len(text)] if self.start < len(text) else []), np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        power, inverse = _powers_to(len(text))
        sums = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum(settle(points + K1) * power[:len(text)], out=sums[1:])
        names = settle((sums[ends] - sums[starts]) * inverse[starts]
                       + (ends - starts).astype(np.uint64) * K1)
        least = np.full(PLACES, ~np.uint64(0))
        np.minimum.at(least, (names & np.uint64(PLACES - 1)).astype(np.int64), names)
        found = least != ~np.uint64(0)
        out[found] = (settle(least[found]) >> np.uint64(48)).astype(np.uint32)
        return out


def parsed(text: str) -> np.ndarray:
    return Phrases().read(text, 0, len(text)).codes(text)


def written(codes: np.ndarray) -> str:
    """Four hexadecimal digits a place; dashes where no phrase fell."""
    return "".join("----" if c == EMPTY else f"{c:04x}" for c in codes.tolist())


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, the share of used places that agree; 1 for two empty texts."""
    used = ((a != EMPTY) | (b != EMPTY)).sum(1)
    same = ((a == b) & (a != EMPTY)).sum(1)
    return np.where(used > 0, same / np.maximum(used, 1), 1.0)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every whole text; a null text is empty (all dashes).

    Equal texts have equal fingerprints and compare as 1; the share of equal places estimates the
    Jaccard similarity of the phrase sets. Rows that repeat are each given theirs.
    """
    small_batches(docs.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"),
                "fingerprint": [written(parsed(t)) for t in b.column("text").to_pylist()]})

    return id_and_text(docs).mapInArrow(each, "doc_id long, fingerprint string")


def _dealt_by_range(docs: DataFrame, range_bytes: int) -> DataFrame:
    """``part, tail, doc_id, text``: ranges of ids, each with a copy of the row that follows it.

    A range begins at an id that occurs, so the row that follows a range is known before the one
    shuffle; the first document of all follows the last range. What the driver sees is one id for
    each range.
    """
    spark = docs.sparkSession
    parts = int(max(1, -(-total_bytes(docs) // range_bytes)))
    order = F.coalesce("doc_id", F.lit(LOWEST))
    cuts = [k / parts for k in range(1, parts)]
    least, found = docs.agg(F.min(order), F.percentile_approx(
        order, cuts, F.lit(max(10_000, 20 * parts))) if cuts else F.array()).first()
    heads = np.array(sorted({least, *(found or [])}) if least is not None else [], dtype=np.int64)
    small_batches(spark)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = order_ids(b.column("doc_id"))
            part = np.searchsorted(heads, ids, side="right") - 1
            head = np.flatnonzero(heads[part] == ids)
            for rows, where, tail in ((None, part, False), (head, (part[head] - 1) % len(heads), True)):
                if rows is None or len(rows):
                    own = b if rows is None else b.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(where.astype(np.int32)), pa.array(np.full(len(where), tail)),
                         *own.columns], ["part", "tail", "doc_id", "text"])

    return docs.mapInArrow(deal, "part int, tail boolean, doc_id long, text string")


def edited_fingerprints(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last ``n_chars // 2`` code points replaced by the first as many of the
    next document's, in ascending order of ids (null first, equal ids by text; the last is followed
    by the first); all of it if it is shorter. Returns ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``. A document alone is its own next.
    """
    source = id_and_text(docs)

    def compare(key, table):
        order = pc.sort_indices(table, sort_keys=[("tail", "ascending"), ("doc_id", "ascending"),
                                                  ("text", "ascending")],
                                null_placement="at_start")
        table = table.take(order)
        texts = table.column("text").to_pylist()
        n = len(texts) - int(pc.sum(pc.cast(table.column("tail"), pa.int64())).as_py() or 0)
        plain, edited, shas = [], [], []
        for i, text in enumerate(texts[:n + 1]):
            if i == n:
                plain.append(parsed(text))
                break
            half = len(text) // 2
            keep = len(text) - half
            new = text[:keep] + texts[i + 1][:half]
            shas.append(hashlib.sha256(new.encode()).hexdigest())
            shared = Phrases().read(text, 0, keep)
            other = shared.fork()
            plain.append(shared.read(text, keep, len(text)).codes(text))
            edited.append(other.read(new, keep, len(new)).codes(new))
        own = np.array(plain[:n], dtype=np.uint32).reshape(-1, PLACES)
        follow = np.array(plain[1:n + 1], dtype=np.uint32).reshape(-1, PLACES)
        new = np.array(edited, dtype=np.uint32).reshape(-1, PLACES)
        return pa.table({
            "doc_id": table.column("doc_id").slice(0, n),
            "n_chars": pa.array([len(t) for t in texts[:n]], pa.int64()),
            "edited_sha256": pa.array(shas, pa.string()),
            "fingerprint": pa.array([written(c) for c in own], pa.string()),
            "edited_fingerprint": pa.array([written(c) for c in new], pa.string()),
            "near_edited": likeness(own, new), "near_next": likeness(own, follow)})

    return _dealt_by_range(source, range_bytes).groupBy("part").applyInArrow(
        compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                 "edited_fingerprint string, near_edited double, near_next double")
