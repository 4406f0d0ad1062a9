"""Offsets and fragment numbers of the words of whole bodies, by running sums in a batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fragment size in characters, smallest last piece.
FRAGMENT, LAST_PIECE = 70, 35

WORD_FIELDS = [("pos", pa.int32()), ("term", pa.string()), ("start", pa.int32()),
               ("end", pa.int32()), ("frag_no", pa.int32())]
WORDS_TYPE = T.ArrayType(T.StructType([
    T.StructField("pos", T.IntegerType()), T.StructField("term", T.StringType()),
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("frag_no", T.IntegerType())]))


def _sums(values: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Running sums that begin anew with every document."""
    totals = np.bincount(doc, weights=values, minlength=n_docs).astype(np.int64)
    return np.cumsum(values) - (np.cumsum(totals) - totals)[doc]


@F.arrow_udf(WORDS_TYPE)
def cut_words(spans: pa.Array, blocked: pa.Array) -> pa.Array:
    """Kept words of each body with place, offsets and fragment number.

    A word starts a new fragment once its end passes the next multiple of FRAGMENT,
    unless fewer than LAST_PIECE characters remain after it, it is the first, or its
    place is blocked. One fragment starts per word at most, so a very long word leaves
    the count behind and the next words catch up: the number is ``a + min(f - a)`` over
    the words so far, with ``a`` the words that may start one and ``f`` the multiples.
    """
    sizes = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    n_docs, flat = len(sizes), spans.flatten()
    gap, size = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64)
                 for c in ("gap", "size"))
    tail = flat.field("tail").to_numpy(zero_copy_only=False).astype(np.int64)
    terms = flat.field("term")
    doc = np.repeat(np.arange(n_docs), sizes)
    end = _sums(gap + size, doc, n_docs)
    length = np.bincount(doc, weights=gap + size, minlength=n_docs).astype(np.int64)
    pos = _sums(np.ones_like(doc), doc, n_docs) - 1 - _sums(tail, doc, n_docs)

    kept = np.flatnonzero(terms.is_valid().to_numpy(zero_copy_only=False))
    doc, end, pos, size = doc[kept], end[kept], pos[kept], size[kept]
    may = length[doc] - end >= LAST_PIECE
    may[np.flatnonzero(np.diff(doc, prepend=-1))] = False
    walls = pc.fill_null(pc.list_value_length(blocked), 0).to_numpy(zero_copy_only=False)
    if walls.sum():
        wide = int(pos.max(initial=0)) + 1
        places = blocked.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        may &= ~np.isin(doc * wide + pos, np.repeat(np.arange(n_docs), walls) * wide + places)
    a = _sums(may.astype(np.int64), doc, n_docs)
    behind = np.where(may, end // FRAGMENT - a, 0)
    counts = np.bincount(doc, minlength=n_docs)
    stops = np.cumsum(counts)
    for begin, stop in zip(stops - counts, stops):
        np.minimum.accumulate(behind[begin:stop], out=behind[begin:stop])
    columns = [pos, terms.take(pa.array(kept)), end - size, end, a + np.minimum(0, behind)]
    words = pa.StructArray.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c.astype(np.int32)) for c in columns],
        names=[name for name, _ in WORD_FIELDS])
    offsets = pa.array(np.concatenate([[0], stops]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, words)
