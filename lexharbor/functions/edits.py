"""Edit distance with adjacent transposition, and its candidate keys."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Two words within two edits share a key when up to two characters are deleted from
# the first KEY_CHARS of each, so longer words need no more keys than MOST_KEYS.
KEY_CHARS = 7
MOST_KEYS = 1 + KEY_CHARS + KEY_CHARS * (KEY_CHARS - 1) // 2
# Distances are told apart up to REACH; beyond that they are FAR.
REACH, FAR = 2, 3


def deletion_keys(term: Column, chars: int = KEY_CHARS) -> Column:
    """Every string left by deleting at most two of the first ``chars`` characters.

    Written out place by place, so no function is called per character; places beyond the end
    of a short word leave nulls.
    """
    head = F.substring(term, F.lit(1), F.lit(chars))
    size = F.length(head)

    def part(start: int, stop: int) -> Column:
        return F.substring(head, F.lit(start), F.lit(stop - start + 1))

    kept = [head]
    for i in range(1, chars + 1):
        kept.append(F.when(size >= i, F.concat(part(1, i - 1), part(i + 1, chars))))
        kept += [F.when(size >= j, F.concat(part(1, i - 1), part(i + 1, j - 1), part(j + 1, chars)))
                 for j in range(i + 1, chars + 1)]
    return F.array_distinct(F.array(*kept))


def _codes(words: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    points = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words]
    sizes = np.array([len(p) for p in points], np.int64)
    grid = np.zeros((len(points), int(sizes.max(initial=0))), np.uint32)
    for row, p in enumerate(points):
        grid[row, : len(p)] = p
    return grid, sizes


@F.pandas_udf(T.IntegerType())
def swap_distance(left: pd.Series, right: pd.Series) -> pd.Series:
    """Edits between two words, up to ``FAR``; swapping two neighbours counts as one edit.

    Words within two edits stay within two places of each other, so only five diagonals of
    the table of distances are filled, two rows of it at a time, for all pairs of the batch
    at once: memory grows with the batch alone, however long the words.
    """
    a, na = _codes(left)
    b, nb = _codes(right)
    rows, wide = len(na), a.shape[1]
    band = np.arange(-REACH, REACH + 1)
    pad = np.zeros((rows, REACH + 1), np.uint32)
    b = np.concatenate([pad, b, np.zeros((rows, max(0, wide - b.shape[1]) + REACH + 1), np.uint32)], 1)
    before = np.full((2 * REACH + 1, rows), FAR, np.int32)
    last = np.where(band[:, None] >= 0, np.minimum(band[:, None], FAR), FAR).astype(np.int32)
    last = np.repeat(last, rows, axis=1)
    out = np.full(rows, FAR, np.int32)

    def note(i: int, row: np.ndarray) -> None:
        done = np.flatnonzero((na == i) & (np.abs(nb - i) <= REACH))
        out[done] = row[(nb[done] - i) + REACH, done]

    note(0, last)
    for i in range(1, wide + 1):
        row = np.full_like(last, FAR)
        for k, d in enumerate(band.tolist()):
            j = i + d
            if j < 0:
                continue
            if j == 0:
                row[k] = min(i, FAR)
                continue
            at = j + REACH          # column of b's j-th sign
            best = last[k] + (a[:, i - 1] != b[:, at])
            if k + 1 <= 2 * REACH:
                best = np.minimum(best, last[k + 1] + 1)
            if k:
                best = np.minimum(best, row[k - 1] + 1)
            if i > 1 and j > 1:
                swapped = (a[:, i - 1] == b[:, at - 1]) & (a[:, i - 2] == b[:, at])
                best = np.where(swapped, np.minimum(best, before[k] + 1), best)
            row[k] = np.minimum(best, FAR)
        note(i, row)
        before, last = last, row
    return pd.Series(out, dtype="int32")
