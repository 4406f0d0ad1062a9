"""Repeated windows of tokens, found and confirmed over all documents.

A window is ``width`` consecutive tokens of one document. It repeats if its tokens also stand at
an earlier place. The two substring operators differ in their tokens, in how they choose anchors
and in the order of places; the rounds over the corpus are the same:

1. Every window chooses one *anchor* by its own content, so equal windows choose the same anchor
   at the same offset. Only the name of the few tokens around an anchor is shuffled, once for
   each block of documents; anchors with a name found nowhere else are done.
2. For anchors with a shared name, the name of the whole stretch covered by the windows that
   chose them is compared. A stretch seen earlier settles all its windows; a name with one
   single stretch settles them too. This leaves the ends of repeated passages.
3. What neighbouring windows of such an anchor have in common is compared (if the scheme says
   so), then the windows that are still in doubt, one by one.

What a round finds goes back to the blocks as names. A block sends each name once, with its first
place, so a passage that stands in a third of all documents costs a row for each block, not for
each document. Rounds that only sort out candidates keep as many bits of a name as the size of the
corpus asks for; a chance match there costs a comparison. What decides compares 64 bits of the
longer string together with the anchor's name.

The first round, the second and the third are queries of their own: the small results of the first
two are written and their shuffle files go before the next begins. Each shuffles the texts anew,
which costs less than to keep all files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (in_blocks, in_sorted, order_ids, pair_names, settle, signed, unsigned,
                     written_round)

DUPLICATE, OPEN, WINDOW = 1, 2, 3


@dataclass
class Parsed:
    """Tokens of one block: where documents begin, and for every window start its anchor."""

    bounds: np.ndarray                                    # token offsets of the documents
    width: int
    anchor: np.ndarray                                    # anchor of the window at each start
    core_of: Callable[[np.ndarray], np.ndarray]           # names around anchors
    name_all: Callable[[], np.ndarray]                    # names of the windows at all starts
    common_of: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None
    share: int = 0                                        # offsets that one common name covers

    @cached_property
    def name(self) -> np.ndarray:
        return self.name_all()


class Stretches:
    """Runs of windows that chose the same anchor; documents stand in ascending order of ids."""

    def __init__(self, p: Parsed, ids: np.ndarray, by_place: bool, bits: int):
        self.p, self.by_place, self.ids = p, by_place, ids
        n = len(p.anchor)
        if n:
            change = np.ones(n, dtype=bool)
            np.not_equal(p.anchor[1:], p.anchor[:-1], out=change[1:])
            inner = p.bounds[1:-1]
            change[inner[inner < n]] = True
            first = np.flatnonzero(change)
            row = np.searchsorted(p.bounds, first, side="right") - 1
            limit = p.bounds[row + 1] - p.width
            last = np.minimum(np.append(first[1:], n) - 1, limit)
            real = first <= limit
            first, last, row = first[real], last[real], row[real]
        else:
            first = last = row = np.zeros(0, dtype=np.int64)
        self.first, self.last, self.row = first, last, row
        self.at = p.anchor[first].astype(np.int64)
        self.core = p.core_of(self.at) >> np.uint64(64 - bits)
        self.doc = ids[row]

    @cached_property
    def place(self) -> np.ndarray:
        return self.first - self.p.bounds[self.row] if self.by_place else np.zeros_like(self.first)

    @cached_property
    def name(self) -> np.ndarray:
        p, f, t = self.p, self.first, self.last
        reach = ((self.at - f) * 4096 + (t - f)).astype(np.uint64)
        return settle(pair_names(pair_names(p.name[f], p.name[t]), reach))

    @cached_property
    def grouped(self) -> tuple[np.ndarray, np.ndarray]:
        """The first of equal stretches, and which are later than the first."""
        return first_of_equals(settle(pair_names(self.core, self.name)), self.doc, self.place)

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All window starts of some stretches, and the stretch of each."""
        size = self.last[which] - self.first[which] + 1
        own = np.repeat(which, size)
        return np.arange(len(own)) + np.repeat(self.first[which] - (np.cumsum(size) - size),
                                               size), own


def first_of_equals(key: np.ndarray, doc: np.ndarray, place: np.ndarray):
    """The first of each key by (doc, place), and which entries come after it."""
    ahead = (doc[1:] > doc[:-1]) | ((doc[1:] == doc[:-1]) & (place[1:] >= place[:-1]))
    # entries stand in order but where several texts have one id
    order = np.argsort(key, kind="stable") if ahead.all() else np.lexsort((place, doc, key))
    sorted_key = key[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    heads = order[new]
    head = np.empty(len(order), dtype=np.int64)
    head[order] = heads[np.cumsum(new) - 1]
    later = (doc > doc[head]) | ((doc == doc[head]) & (place > place[head]))
    return heads, later


def _ordered(docs: pa.Table) -> pa.Table:
    """Documents by id (null first); rows that repeat an id by text."""
    keys = [("doc_id", "ascending"), ("text", "ascending")]
    ids = docs.column("doc_id")
    if len(pc.unique(ids)) == len(ids):
        keys = keys[:1]
    return docs.take(pc.sort_indices(docs, sort_keys=keys, null_placement="at_start"))


def _rows(key=None, core=None, name=None, doc=None, place=None) -> pa.Table:
    """Rows for the rounds; ``at`` holds the place and, in its low half, the block to answer."""
    empty = np.zeros(0, dtype=np.int64)
    if key is None:
        return pa.table({"core": empty, "name": empty, "doc": empty, "at": empty})
    return pa.table({"core": signed(core), "name": signed(name), "doc": doc,
                     "at": (place.astype(np.int64) << 32) + key[0].as_py()})


def repeats(docs: DataFrame, parse: Callable[[pa.Table], Parsed], by_place: bool,
            finish: Callable[[pa.Table, Parsed, np.ndarray], pa.Table], schema: str,
            refine: bool = False) -> DataFrame:
    """Run the rounds over ``docs`` and give each block to ``finish`` with a mark per window start.

    ``by_place``: an earlier start in the same document counts as earlier too.
    """
    blocks, bits = in_blocks(docs)
    place = F.struct("doc", F.shiftright("at", 32))
    block_of_row = F.col("at").bitwiseAND(F.lit(2 ** 32 - 1)).cast("int").alias("block")
    rows = "core long, name long, doc long, at long"
    at_name = Window.partitionBy("core", "name")

    def read(table):
        table = _ordered(table)
        return table, Stretches(parse(table), order_ids(table.column("doc_id")), by_place, bits)

    def counted(key, names):
        name, count = np.unique(names, return_counts=True)
        return pa.table({"block": np.full(len(name), key[0].as_py(), np.int32),
                         "core": signed(name), "many": count > 1})

    def kept_shared(found: DataFrame) -> DataFrame:
        """Names that several blocks have, or one block more than once; a row for each block."""
        same = Window.partitionBy("core")
        return (found.withColumn("n", F.count("*").over(same))
                .withColumn("m", F.max("many").over(same))
                .filter("n > 1 OR m").select("block", "core"))

    def cores(key, table):
        return counted(key, read(table)[1].core)

    shared = written_round(kept_shared(blocks.groupBy("block").applyInArrow(
        cores, "block int, core long, many boolean")), "shared-names")

    def stretches(key, table, known):
        if not table.num_rows or not known.num_rows:
            return _rows()
        _, s = read(table)
        heads = s.grouped[0]
        h = heads[in_sorted(s.core[heads], np.sort(unsigned(known.column("core"))))]
        return _rows(key, s.core[h], s.name[h], s.doc[h], s.place[h])

    by_stretch = (blocks.groupBy("block").cogroup(shared.groupBy("block"))
                  .applyInArrow(stretches, rows))
    at_core = Window.partitionBy("core")
    judged = (by_stretch.withColumn("least", F.min("name").over(at_core))
              .withColumn("most", F.max("name").over(at_core))
              .withColumn("first", F.min(place).over(at_name))
              .withColumn("kind", F.when(place > F.col("first"), F.lit(DUPLICATE))
                          .when(F.col("least") != F.col("most"), F.lit(OPEN)))
              .filter("kind IS NOT NULL")
              .select(block_of_row, F.col("kind").cast("int").alias("kind"), "name"))
    judged = written_round(judged, "judged-stretches")
    doubtful = judged.filter(F.col("kind") == OPEN)

    def said_of(said, kind):
        return np.sort(unsigned(said.filter(pc.equal(said.column("kind"), kind)).column("name")))

    def settled(s: Stretches, said):
        """Of stretches: duplicates, and those whose windows must be compared."""
        duplicate = s.grouped[1] | in_sorted(s.name, said_of(said, DUPLICATE))
        return duplicate, ~duplicate & in_sorted(s.name, said_of(said, OPEN))

    def commons(s: Stretches, start, own):
        """For windows, the name of what they have in common with their neighbours."""
        part = (s.at[own] - start) // s.p.share
        return settle(s.p.common_of(s.at[own], part) + part.astype(np.uint64)) \
            >> np.uint64(64 - bits)

    if refine:
        def parts(key, table, said):
            names = np.zeros(0, dtype=np.uint64)
            if table.num_rows and said.num_rows:
                _, s = read(table)
                start, own = s.windows(np.flatnonzero(settled(s, said)[1]))
                part = (s.at[own] - start) // s.p.share
                once = np.ones(len(own), dtype=bool)
                once[1:] = (own[1:] != own[:-1]) | (part[1:] != part[:-1])
                names = commons(s, start[once], own[once])
            return counted(key, names)

        near = kept_shared(blocks.groupBy("block").cogroup(doubtful.groupBy("block"))
                           .applyInArrow(parts, "block int, core long, many boolean"))
        doubtful = doubtful.unionByName(near.select(
            "block", F.lit(WINDOW).cast("int").alias("kind"), F.col("core").alias("name")))

    def windows_of(s: Stretches, open_, said):
        """Windows to compare: start, stretch, heads among equals, which have an earlier one here."""
        start, own = s.windows(np.flatnonzero(open_))
        if refine:
            near = in_sorted(commons(s, start, own), said_of(said, WINDOW))
            start, own = start[near], own[near]
        name = s.p.name[start] if len(start) else np.zeros(0, dtype=np.uint64)
        at = start - s.p.bounds[s.row[own]] if by_place else np.zeros_like(start)
        heads, later = first_of_equals(settle(pair_names(s.core[own], name)), s.doc[own], at)
        return start, own, name, at, heads, later

    def windows(key, table, said):
        if not table.num_rows or not said.num_rows:
            return _rows()
        _, s = read(table)
        _, own, name, at, h, _ = windows_of(s, settled(s, said)[1], said)
        return _rows(key, s.core[own[h]], name[h], s.doc[own[h]], at[h])

    by_window = (blocks.groupBy("block").cogroup(doubtful.groupBy("block"))
                 .applyInArrow(windows, rows))
    earlier = (by_window.withColumn("first", F.min(place).over(at_name))
               .filter(place > F.col("first"))
               .select(block_of_row, F.lit(0).cast("int").alias("kind"), "name"))
    answers = judged.unionByName(earlier)
    if refine:
        answers = answers.unionByName(doubtful.filter(F.col("kind") == WINDOW))

    def last(key, table, said):
        table, s = read(table)
        duplicate, open_ = settled(s, said)
        n = len(s.p.anchor)
        step = np.zeros(n + 1, dtype=np.int32)
        step[s.first[duplicate]] += 1
        step[s.last[duplicate] + 1] -= 1
        mark = np.cumsum(step[:-1], dtype=np.int32) > 0
        start, _, name, _, _, later = windows_of(s, open_, said)
        mark[start[later | in_sorted(name, said_of(said, 0))]] = True
        return finish(table, s.p, mark)

    return (blocks.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(last, schema))


def covered(mark: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of ``size`` tokens lie in a window whose start is marked."""
    step = np.zeros(size + 1, dtype=np.int32)
    step[:len(mark)] += mark
    step[width:width + len(mark)] -= mark
    return np.cumsum(step[:-1], dtype=np.int32) > 0
