"""Periodic runs of words: stretches that repeat a block of words at least twice.

Every word follows the diagonals of its earlier occurrences: at lag ``q`` a word that equals the
word ``q`` before it adds one to the match length its diagonal has there, any other word ends the
diagonal, and a diagonal that ends with ``q`` matches or more is a run of period ``q``. Only cells
that can belong to such a diagonal are visited:

* Lags below eight are followed word by word.
* A diagonal of lag ``w`` to ``2w - 1`` needs ``w`` matches, so it is followed over the earlier
  occurrences of the ``w`` words that start at a place. Places whose ``w`` words occur once drop
  out, and with them all longer strings that begin there.
* Strings whose own period is at most ``w / 4`` lie in a run found before and would have too many
  occurrences. A diagonal seen by such strings alone joins two neighbouring runs of that smaller
  period, so its lags follow from the pair.

So a text of ``n`` words takes about ``n log n`` steps even if it is one word repeated, and memory
in proportion to its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, Words, doubled_names, id_and_text, pair_names, small_batches

LEAST_LENGTH = 12
FIRST = 8
# Text taken at once by a task; a longer text comes alone.
SLICE_BYTES = 4 << 20
FOUND = ("doc_id long, runs array<struct<start: long, length: long, period: long>>, kept string")


def _stretches(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each stretch of consecutive numbers."""
    if not len(hit):
        return hit, hit
    cut = np.flatnonzero(np.diff(hit) != 1)
    return hit[np.r_[0, cut + 1]], hit[np.r_[cut, len(hit) - 1]]


def _repeated(names: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose name occurs more than once, and the names, by name, then place."""
    order = np.argsort(names)
    ranked = names[order]
    same = ranked[1:] == ranked[:-1]
    several = np.zeros(len(ranked), dtype=bool)
    several[1:] |= same
    several[:-1] |= same
    names, places = ranked[several], places[order[several]]
    order = np.lexsort((places, names))
    return names[order], places[order]


def _matches(words: np.ndarray, at: int, lag: int, back: bool = False) -> int:
    """How many words from ``at`` on, or before it, equal the words ``lag`` before them."""
    done, size = 0, 16
    while True:
        if back:
            high = at - done
            low = max(high - size, lag)
            differ = np.flatnonzero(words[low:high] != words[low - lag:high - lag])
            if len(differ):
                return done + high - low - 1 - int(differ[-1])
            done += max(high - low, 0)
            if low <= lag:
                return done
        else:
            low = at + done
            high = min(low + size, len(words))
            differ = np.flatnonzero(words[low:high] != words[low - lag:high - lag])
            if len(differ):
                return done + int(differ[0])
            done += max(high - low, 0)
            if high == len(words):
                return done
        size *= 2


class Runs:
    """All maximal runs of a sequence of names, found level by level."""

    def __init__(self, words: np.ndarray):
        self.words = words
        # (start, end) -> smallest period: a greater one of the same stretch comes later
        self.found: dict[tuple[int, int], int] = {}
        for lag in range(1, min(FIRST, len(words))):
            low, high = _stretches(np.flatnonzero(words[lag:] == words[:-lag]))
            length = high - low + 1 + lag
            for a, n in zip(low[k := length >= max(FIRST, 2 * lag)].tolist(), length[k].tolist(),
                            strict=True):
                self._emit(a, a + n, lag)
        names = doubled_names(words, FIRST)
        names, places = _repeated(names, np.arange(len(names))) if len(names) else (names, names)
        width = FIRST
        while len(places):
            self._pairs_of_runs(width)
            self._diagonals(names, places, width)
            names, places = self._doubled(names, places, width)
            width *= 2

    def _emit(self, start: int, end: int, lag: int) -> None:
        if end - start >= 2 * lag:
            self.found.setdefault((start, end), lag)

    def _doubled(self, names, places, width) -> tuple[np.ndarray, np.ndarray]:
        """Names of strings twice as long, at the places that still occur more than once."""
        order = np.argsort(places)
        names, places = names[order], places[order]
        other = np.searchsorted(places, places + width)
        other[other == len(places)] = 0
        both = places[other] == places + width
        return _repeated(pair_names(names[both], names[other[both]]), places[both])

    def _own_period(self, places: np.ndarray, width: int) -> np.ndarray:
        """Which strings lie in a run whose period is at most a quarter of their length."""
        spans = [(s, e - width) for (s, e), q in self.found.items()
                 if 4 * q <= width and e - s >= width]
        if not spans:
            return np.zeros(len(places), dtype=bool)
        low, high = np.array(sorted(spans)).T
        high = np.maximum.accumulate(high)
        k = np.searchsorted(low, places, side="right") - 1
        return (k >= 0) & (places <= high[k])

    def _diagonals(self, names, places, width) -> None:
        """Follow the diagonals of lags ``width`` to ``2 * width - 1``."""
        plain = ~self._own_period(places, width)
        names, places = names[plain], places[plain]
        cells, step = [], 1
        while step < len(places):
            lag = places[step:] - places[:-step]
            near = (names[step:] == names[:-step]) & (lag < 2 * width)
            if not near.any():
                break
            far = np.flatnonzero(near & (lag >= width))
            cells.append((lag[far], places[step:][far]))
            step += 1
        if not sum(len(c[0]) for c in cells):
            return
        lag = np.concatenate([c[0] for c in cells])
        at = np.concatenate([c[1] for c in cells])
        order = np.lexsort((at, lag))
        lag, at = lag[order], at[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(at)] - 1
        before, reached = 0, 0
        for q, low, high in zip(lag[first].tolist(), at[first].tolist(), at[last].tolist(),
                                strict=True):
            if q == before and low < reached:
                continue
            start = low - _matches(self.words, low, q, back=True)
            end = high + width + _matches(self.words, high + width, q)
            self._emit(start - q, end, q)
            before, reached = q, end

    def _pairs_of_runs(self, width: int) -> None:
        """Lags at which a run repeats the neighbouring run of the same small period."""
        small = sorted((q, s, e) for (s, e), q in self.found.items()
                       if 4 * q <= width and e - s >= width)
        for (p, s1, e1), (p2, s2, e2) in zip(small, small[1:], strict=False):
            if p != p2 or s2 > e1:
                continue
            block = self.words[s1:min(s1 + 2 * p - 1, e1)].tobytes()
            wanted = self.words[s2:s2 + p].tobytes()
            at = block.find(wanted)
            while at % 8 and at >= 0:
                at = block.find(wanted, at + 1)
            if at < 0:
                continue
            shift = (s2 - s1 - at // 8) % p
            for q in range(width + (shift - width) % p, min(2 * width, e1 - s1 + 1, e2 - s2 + 1), p):
                low, high = max(s2, s1 + q), min(e2, e1 + q)
                if low < high:
                    low -= _matches(self.words, low, q, back=True)
                    high += _matches(self.words, high, q)
                    self._emit(low - q, high, q)


def maximal_runs(words: np.ndarray, least: int = LEAST_LENGTH) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs of at least ``least`` words, by start, then period."""
    return sorted((s, e - s, q) for (s, e), q in Runs(words).found.items() if e - s >= least)


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of text, one row at least."""
    sizes = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(batch):
        yield batch.slice(start)


def _task(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                yield _found(piece, least)
    return run


def _found(batch: pa.RecordBatch, least: int) -> pa.RecordBatch:
    """Runs and kept words of the texts of a batch; a text's words have names of its own."""
    texts = batch.column("text")
    words = Words(texts)
    ends = np.cumsum(words.counts)
    of_text = np.repeat(np.arange(len(batch), dtype=np.uint64), words.counts)
    runs = maximal_runs(pair_names(words.names, of_text + np.uint64(1)), least)
    dropped = np.zeros(len(of_text) + 1, dtype=np.int64)
    for s, n, q in runs:
        dropped[s + q] += 1
        dropped[s + n] -= 1
    dropped = np.cumsum(dropped)[:-1] > 0
    owner = np.searchsorted(ends, [s for s, _, _ in runs], side="right")
    mine: list[list[dict]] = [[] for _ in range(len(batch))]
    for (s, n, q), k in zip(runs, owner.tolist(), strict=True):
        mine[k].append({"start": s - int(ends[k] - words.counts[k]), "length": n, "period": q})
    kept = []
    for k, value in enumerate(texts):
        parts = value.as_py().encode().split()
        if mine[k]:
            gone = dropped[ends[k] - words.counts[k]:ends[k]].tolist()
            parts = [w for w, g in zip(parts, gone, strict=True) if not g]
        kept.append(b" ".join(parts).decode())
    return pa.RecordBatch.from_pydict({
        "doc_id": batch.column("doc_id"),
        "runs": pa.array(mine, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                                   ("period", pa.int64())]))),
        "kept": pa.array(kept, pa.string())})


def find_runs(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """``doc_id, runs, kept`` for every row of ``docs(doc_id, text)``.

    ``runs(start, length, period)`` are the maximal stretches of at least ``least`` consecutive
    words with their smallest period, at least twice as long as it, by start, then period; ``kept``
    joins by one space the words that no run contains after its first period. Words are what white
    space of ASCII separates. A null or blank text has no runs and keeps nothing; null and repeated
    ids keep their rows; an empty table gives no rows; other columns are not read. Rows are judged
    alone, without a shuffle.
    """
    small_batches(docs.sparkSession)
    return id_and_text(docs).mapInArrow(_task(least), FOUND)


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where a tenth of the texts, picked by id, end in a block said over again.

    With ``h`` the crc32 of the decimal id and ``g`` a tenth of it: if ``h`` ends in 0, the words
    from ``a = g % n`` on repeat the first ``p = 1 + (n - a) div (3 + g % 8)`` of them. Texts of
    null ids stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    pattern = WORD_PATTERN.replace("\\", "\\\\")
    picked = id_and_text(docs).withColumn("g", F.when(h % 10 == 0, g)).withColumn(
        "w", F.when(F.col("g").isNotNull(), F.expr(f"regexp_extract_all(text, '{pattern}', 0)")))
    tail = """array_join(transform(sequence(0, size(w) - 1), i -> get(w, cast(
        if(i < g % size(w), i, g % size(w) + (i - g % size(w)) %
           (1 + (size(w) - g % size(w)) div (3 + g % 8))) as int))), ' ')"""
    return picked.select("doc_id", F.when(F.col("g").isNotNull() & (F.size("w") > 0), F.expr(tail))
                         .otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """A row per document: its number of runs, its longest one and digests of runs and kept words."""
    best = F.expr("""array_min(transform(runs, r -> struct(-r.length as n, r.start as start,
                                                           r.period as period)))""")
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                    r["period"].cast("string")), F.lit("\n"))))
    length = -F.col("best.n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        length.alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * -best.n) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))
