"""Removal of repeated word passages (recompression) and byte strings (prefix doubling)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Words, doubled_names, id_and_text, pair_names, settle, texts_buffer
from .repeats import Parsed, covered, repeats

WINDOW_WORDS = 20
WINDOW_BYTES = 50
# Bytes around an anchor whose name is compared first in the prefix doubling.
CORE_BYTES = 20
# Neighbouring windows of one anchor, so many at a time, are first compared by what they share.
SHARE = 5
# After naming runs of two, and pairs twice, the parse at a gap rests on this many words each side.
REACH = 7


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The minimum of every ``span`` neighbours, by doubling."""
    have, at = 1, values
    while have < span and len(at):
        step = min(have, span - have)
        at = np.minimum(at[:-step], at[step:]) if len(at) > step else at[:0]
        have += step
    return at


def _named_round(names: np.ndarray, begin: np.ndarray, row: np.ndarray,
                 merge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Replace each symbol with ``merge`` and its right neighbour by the name of the pair."""
    at = np.flatnonzero(merge)
    names = names.copy()
    names[at] = settle(pair_names(names[at], names[at + 1]))
    keep = np.ones(len(names), dtype=bool)
    keep[at + 1] = False
    return names[keep], begin[keep], row[keep]


def recompress(names: np.ndarray, row: np.ndarray, pairings: int = 2) -> np.ndarray:
    """Starts of the symbols left after naming runs, then pairs ``pairings`` times.

    A run of exactly two equal words becomes one symbol. Then, in each round, a hash deals the
    symbols into left and right ones and every left one followed by a right one becomes a pair.
    Names are hashes of what they stand for, so they agree over the whole corpus without a table,
    and equal strings get equal symbols but for ``REACH`` words at either end. Longer runs stay
    as they are, which keeps that reach bounded.
    """
    begin = np.arange(len(names))
    if len(names) < 2:
        return begin
    equal = (names[1:] == names[:-1]) & (row[1:] == row[:-1])
    two = equal.copy()
    two[1:] &= ~equal[:-1]
    two[:-1] &= ~equal[1:]
    names, begin, row = _named_round(names, begin, row, two)
    for k in range(pairings):
        if len(names) < 2:
            break
        left = (settle(names + np.uint64(k + 1)) & np.uint64(1)) == 0
        names, begin, row = _named_round(names, begin, row,
                                         left[:-1] & ~left[1:] & (row[1:] == row[:-1]))
    return begin


def _picked(values: np.ndarray, span: int) -> np.ndarray:
    """Position of the least of every ``span`` neighbours, the leftmost of equals; -1 if all empty.

    ``values`` has its least bits replaced by positions, so its minima name their place.
    """
    low = (np.uint64(1) << np.uint64(max(len(values), 2).bit_length())) - np.uint64(1)
    best = _least((values & ~low) | np.arange(len(values), dtype=np.uint64), span)
    return np.where(best >= EMPTY & ~low, -1, (best & low).view(np.int64))


EMPTY = ~np.uint64(0)


def parse_words(docs: pa.Table, width: int = WINDOW_WORDS) -> Parsed:
    """Windows of words; the anchor is a symbol boundary well inside the window.

    The boundary of least hashed surroundings among those that the window's own words determine;
    a window without one takes its middle.
    """
    words = Words(docs.column("text"))
    bounds = np.concatenate([[0], np.cumsum(words.counts)])
    n = len(words.names)
    if n < width:
        none = np.zeros(0, dtype=np.int64)
        return Parsed(bounds, width, none, lambda at: at.view(np.uint64),
                      lambda: none.view(np.uint64))
    owner = np.repeat(np.arange(len(words.counts)), words.counts)
    around = settle(doubled_names(words.names, 2 * REACH))    # around[g - REACH]: gap g
    pick = np.full(n + 1, EMPTY)
    gaps = recompress(words.names, owner)
    gaps = gaps[(gaps >= REACH) & (gaps <= n - REACH)]
    pick[gaps] = around[gaps - REACH] >> np.uint64(1)
    start = np.arange(n - width + 1)
    found = _picked(pick, width - 2 * REACH + 1)[REACH:REACH + len(start)]
    anchor = np.where(found < 0, start + width // 2, found)
    return Parsed(bounds, width, anchor, lambda at: around[at - REACH],
                  lambda: settle(doubled_names(words.names, width)))


class ByteNames:
    """Names of all strings of one size: eight bytes are their own first name, more by doubling.

    An object and not a closure that calls itself: that would be a cycle, and its arrays would
    wait for the garbage collector.
    """

    def __init__(self, raw: np.ndarray):
        self.n = len(raw)
        self.known = {8: np.ndarray((self.n - 7,), dtype="<u8", buffer=np.ascontiguousarray(raw),
                                    strides=(1,)).astype(np.uint64)}

    def of(self, size: int) -> np.ndarray:
        """Two strings of half the size or more name the whole."""
        if size not in self.known:
            half = 8
            while 2 * half < size:
                half *= 2
            part = self.of(half)
            self.known[size] = pair_names(part[:self.n - size + 1], part[size - half:])
        return self.known[size]


def parse_bytes(docs: pa.Table, width: int = WINDOW_BYTES) -> Parsed:
    """Windows of bytes; the anchor is the least named string of ``CORE_BYTES`` in the window."""
    raw, bounds = texts_buffer(docs.column("text"))
    n = len(raw)
    if n < width:
        none = np.zeros(0, dtype=np.int64)
        return Parsed(bounds, width, none, lambda at: at.view(np.uint64),
                      lambda: none.view(np.uint64))
    names = ByteNames(raw)
    core = settle(names.of(CORE_BYTES))
    anchor = _picked(core >> np.uint64(1), width - CORE_BYTES + 1)
    common = width - SHARE + 1

    def common_of(at: np.ndarray, part: np.ndarray) -> np.ndarray:
        return names.of(common)[at - part * SHARE]

    return Parsed(bounds, width, anchor, lambda at: core[at], lambda: settle(names.of(width)),
                  common_of, SHARE)


def remove_repeated_words(docs: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """Drop every word in a window of ``width`` words that also starts earlier in the corpus.

    Earlier: a smaller ``doc_id``, or an earlier start in the same document. Returns ``doc_id,
    n_words, n_removed, kept_sha256, kept`` with the kept words joined by one space. A null text
    has no words; a document shorter than a window keeps all; rows that repeat a ``doc_id`` count
    as the same place, so copies among them stay; a null id comes before all others.
    """
    def finish(table: pa.Table, p: Parsed, mark: np.ndarray) -> pa.Table:
        words = Words(table.column("text"))
        gone = covered(mark, width, len(words.names))
        raw = words.raw.tobytes()
        end = np.cumsum(words.counts)
        kept, removed = [], []
        for first, stop in zip(end - words.counts, end, strict=True):
            cut = gone[first:stop]
            removed.append(int(cut.sum()))
            at = first + np.flatnonzero(~cut)
            kept.append(b" ".join([raw[a:b] for a, b in zip(words.starts[at].tolist(),
                                                            words.ends[at].tolist())]))
        return pa.table({
            "doc_id": table.column("doc_id").combine_chunks(),
            "n_words": pa.array(words.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            "kept": pa.array([k.decode() for k in kept], pa.string())})

    return repeats(id_and_text(docs), lambda t: parse_words(t, width), True, finish,
                   "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def remove_repeated_bytes(docs: DataFrame, width: int = WINDOW_BYTES) -> DataFrame:
    """Drop every byte in a string of ``width`` bytes that also starts in a smaller ``doc_id``.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (binary: a cut may fall
    inside a character). Null and empty texts have no bytes; rows that repeat a ``doc_id`` are
    one document to the order and do not remove from each other; a null id comes first.
    """
    def finish(table: pa.Table, p: Parsed, mark: np.ndarray) -> pa.Table:
        raw, offsets = texts_buffer(table.column("text"))
        gone = covered(mark, width, len(raw))
        removed, spans, kept = [], [], []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            cut = gone[a:b]
            removed.append(int(cut.sum()))
            spans.append(int(cut[:1].sum() + (cut[1:] & ~cut[:-1]).sum()))
            kept.append(raw[a:b][~cut].tobytes())
        return pa.table({
            "doc_id": table.column("doc_id").combine_chunks(),
            "n_bytes": pa.array(np.diff(offsets), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            "kept": pa.array(kept, pa.binary())})

    return repeats(id_and_text(docs), lambda t: parse_bytes(t, width), False, finish,
                   "doc_id long, n_bytes long, n_removed long, n_spans long, "
                   "kept_sha256 string, kept binary", refine=True)
