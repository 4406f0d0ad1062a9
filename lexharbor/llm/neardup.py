"""Near-duplicate documents by SetSketch registers.

A document's set of shingles is sketched by ``REGISTERS`` registers. Register i holds the least of
the set's values under the i-th hash, as an exponential variable, rounded to a power of ``BASE``:
truncated minima at exponential spacing. Registers of a union are the maxima of registers, and two
sets agree in a register a little more often than their Jaccard similarity says. Bands of
``ROWS`` registers give candidates; the joint likelihood of larger, smaller and equal registers
drops hopeless ones; whole sets confirm the rest.

Equal sets are one class from the start. A band's documents are linked to one of them, not to each
other; what such stars leave apart is compared once more within its family, on whole sets inside
the tasks, so no group is spelt out as pairs and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, broadcast_within, count_up_to, materialize
from .common import LOWEST, Words, id_and_text, settle, signed, small_batches
from .components import components
from .containment import distinct_shingles

REGISTERS, ROWS, BASE = 252, 6, 1.02
BANDS = REGISTERS // ROWS
# Candidates whose likeliest similarity is this far under the threshold go; 6 standard deviations.
MARGIN = 0.16
# Members of one star, and documents of each side of a comparison, that meet in a task.
CHUNK, PART = 512, 4096
_SEEDS = np.random.default_rng(3).integers(1, 2 ** 32, (REGISTERS, 2), dtype=np.uint32) | 1


def sketch(names: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Registers of ``rows`` sets given as names sorted by row; empty sets get zeros."""
    out = np.zeros((rows, REGISTERS), dtype=np.int16)
    size = np.bincount(row, minlength=rows)
    full = np.flatnonzero(size)
    if not len(full):
        return out
    first = (np.cumsum(size) - size)[full]
    low = (names & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = (names >> np.uint64(32)).astype(np.uint32)
    least = np.empty((REGISTERS, len(full)), dtype=np.uint32)
    for i, (a, b) in enumerate(_SEEDS):
        least[i] = np.minimum.reduceat(low * a + high * b, first)
    value = -np.log1p(-(least.T.astype(np.float64) + 0.5) / 2.0 ** 32)
    out[full] = np.floor(1 - np.log(value) / np.log(BASE)).astype(np.int16)
    return out


def likely_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard similarity of largest joint likelihood, for rows of registers and set sizes."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u = na / (na + nb)
    v = 1 - u
    grid = np.linspace(0, 1, 101)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    best = np.zeros(len(a))
    top = np.full(len(a), -np.inf)
    for j in grid:
        over, under = p(u - v * j), p(v - u * j)
        fits = (j <= np.minimum(u / v, v / u) + 1e-9)
        value = (more * np.log(np.maximum(over, 1e-12)) + less * np.log(np.maximum(under, 1e-12))
                 + same * np.log(np.maximum(1 - over - under, 1e-12)))
        value = np.where(fits, value, -np.inf)
        better = value > top
        best[better], top[better] = j, value[better]
    return best


def _sketches(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, set1, set2, regs`` of every row; ``set1, set2`` name the whole set."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            names, row = distinct_shingles(Words(b.column("text"), lower=True), width)
            size = np.bincount(row, minlength=n)
            regs = sketch(names, row, n)
            whole = np.zeros((2, n), dtype=np.uint64)
            np.add.at(whole[0], row, settle(names))
            np.add.at(whole[1], row, settle(names ^ np.uint64(0x5DEECE66D)))
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "n": pa.array(size, pa.int64()),
                "set1": signed(whole[0]), "set2": signed(whole[1]),
                "regs": pa.array([r.tobytes() for r in regs], pa.binary())})

    return docs.mapInArrow(each, "doc_id long, n long, set1 long, set2 long, regs binary")


def _shelves(sketches: DataFrame) -> DataFrame:
    """``doc_id, key``: a row for each band; documents with equal registers in it share the key."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                regs = _registers(b.column("regs"))
                bands = np.zeros((b.num_rows, BANDS), dtype=np.uint64)
                for k in range(ROWS):
                    bands = settle(bands * np.uint64(31) + regs[:, k::ROWS].astype(np.uint64))
                bands = settle(bands + np.arange(1, BANDS + 1, dtype=np.uint64))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": np.repeat(b.column("doc_id").to_numpy(), BANDS),
                    "key": signed(bands.ravel())})

    return sketches.select("doc_id", "regs").mapInArrow(each, "doc_id long, key long")


def _registers(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int16).reshape(-1, REGISTERS)


def _hopeful(pairs: DataFrame, floor: float) -> DataFrame:
    """Pairs (with registers and sizes of both) whose likeliest similarity is ``floor`` or more."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                j = likely_similarity(_registers(b.column("regs_a")), _registers(b.column("regs_b")),
                                      b.column("n_a").to_numpy(), b.column("n_b").to_numpy())
                ok = pa.array(j >= floor)
                yield pa.RecordBatch.from_pydict({c: b.column(c).filter(ok) for c in ("a", "b")})

    return pairs.mapInArrow(keep, "a long, b long")


def _confirmed(docs: DataFrame, pairs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough.

    Pairs meet by ``b``, the centre of a star, in chunks of ``CHUNK`` members; the centre's text
    goes once to each of its chunks. Ids are broadcast to the texts if a count shows them few.
    """
    few = count_up_to(pairs, BROADCAST_ROWS)
    members = (pairs.withColumn("part", F.pmod(F.xxhash64("a"), F.lit(1 << 20)))
               .join(pairs.groupBy("b").agg(
                   F.ceil(F.count("*") / CHUNK).alias("parts")), "b")
               .withColumn("part", F.pmod("part", "parts").cast("int")))
    texts = docs.select("doc_id", "text")
    sides = (texts.withColumnRenamed("doc_id", "a").join(broadcast_within(members, few), "a")
             .select("b", "part", "a", "text"))
    centres = (texts.withColumnRenamed("doc_id", "b")
               .join(broadcast_within(members.select("b", "part").distinct(), few), "b")
               .select(F.col("b").alias("c_b"), F.col("part").alias("c_part"),
                       F.col("text").alias("c_text")))

    def sets(table, column):
        names, row = distinct_shingles(Words(table.column(column), lower=True), width)
        return np.split(names, np.cumsum(np.bincount(row, minlength=table.num_rows))[:-1])

    def check(key, left, right):
        out = []
        if left.num_rows and right.num_rows:
            centre = sets(right.slice(0, 1), "c_text")[0]
            for a, own in zip(left.column("a").to_pylist(), sets(left, "text"), strict=True):
                both = len(np.intersect1d(own, centre, assume_unique=True))
                if den * both >= num * (len(own) + len(centre) - both):
                    out.append(a)
        return pa.table({"a": pa.array(out, pa.int64()),
                         "b": pa.array([key[0].as_py()] * len(out), pa.int64())})

    return (sides.groupBy("b", "part").cogroup(centres.groupBy("c_b", "c_part"))
            .applyInArrow(check, "a long, b long"))


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row for each row of ``docs``.

    Documents with a Jaccard similarity of num/den or more of their sets of distinct shingles of
    ``width`` words (ASCII lower case; fewer words are one shingle) are linked; a component is
    named by its least ``doc_id`` and keeps that document. A similar pair shares no band with a
    chance below 3 in a million. Documents without words, null texts among them, are linked with
    nothing; a null ``doc_id`` is kept and linked with nothing; rows that repeat a ``doc_id`` are
    one document to the links, by the text that sorts first, and get the same component.
    """
    small_batches(docs.sparkSession)
    floor = num / den - MARGIN
    source = id_and_text(docs)
    named = source.filter("doc_id IS NOT NULL")
    table = judged = materialize(_sketches(source, width), "sketches")
    twice = materialize(named.groupBy("doc_id").count().filter("count > 1").select("doc_id"),
                        "repeated")
    if not twice.isEmpty():
        first = (named.join(twice, "doc_id", "left_semi").groupBy("doc_id")
                 .agg(F.min("text").alias("text")))
        named = named.join(twice, "doc_id", "left_anti").unionByName(first)
        judged = materialize(_sketches(named, width), "sketches")
    full = judged.filter("doc_id IS NOT NULL AND n > 0")
    same = full.groupBy("set1", "set2").agg(F.min("doc_id").alias("rep"))
    # one row of registers for each class of equal sets, that of its least document
    reps = (full.join(same, (full["set1"] == same["set1"]) & (full["set2"] == same["set2"])
                      & (full["doc_id"] == same["rep"]))
            .select("doc_id", "n", "regs"))
    reps = materialize(reps, "sketch-classes")
    shelves = _shelves(reps)
    shared = (shelves.groupBy("key").agg(F.min("doc_id").alias("hub"), F.count("*").alias("m"))
              .filter("m > 1"))
    stars = materialize(shelves.join(shared, "key").filter("doc_id != hub")
                        .select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct(),
                        "stars")
    regs = reps.select("doc_id", "n", "regs")

    def with_registers(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(regs.withColumnsRenamed(
                {"doc_id": side, "n": f"n_{side}", "regs": f"regs_{side}"}), side)
        return pairs

    pairs = _hopeful(with_registers(stars), floor)
    links = materialize(_confirmed(named, materialize(pairs, "pairs"), width, num, den), "links")
    labels = components(links)
    # what the stars leave apart: documents of one family of shelves in several components
    families = components(stars)
    rest = materialize(_across(named, families, labels, width, num, den), "links")
    if not rest.isEmpty():
        labels = components(links.union(rest))
    rep = same.withColumnsRenamed({"set1": "s1", "set2": "s2"})
    found = (full.select("doc_id", "set1", "set2")
             .join(rep, (F.col("set1") == F.col("s1")) & (F.col("set2") == F.col("s2")))
             .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
             .select("doc_id", F.coalesce("component", "rep").alias("of")))
    return (table.select("doc_id", F.col("n").alias("n_shingles"))
            .join(found, "doc_id", "left")
            .withColumn("component_id", F.coalesce("of", "doc_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
            .select("doc_id", "n_shingles", "component_id", "kept"))


def _across(docs: DataFrame, families: DataFrame, labels: DataFrame, width: int, num: int,
            den: int) -> DataFrame:
    """Links between different components of a family, found on whole sets.

    A family is what shelves join, so every candidate pair lies within one. The documents outside
    its largest component are compared with all of the family, both dealt into parts of ``PART``:
    a task holds two parts, indexes the shingles of one and counts each document of the other
    against the index, and gives one link for each other component a document is similar to. So
    no pair that shares a shelf goes unseen, and none is written out.
    """
    held = (families.select(F.col("node").alias("doc_id"), F.col("component").alias("family"))
            .join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .withColumn("component", F.coalesce("component", "doc_id")))
    sizes = (held.groupBy("family", "component").count().groupBy("family")
             .agg(F.count("*").alias("several"), F.sum("count").alias("all"),
                  F.max("count").alias("most"), F.max_by(
                      F.col("component"), F.struct("count", -F.col("component"))).alias("main"))
             .filter("several > 1")
             .select("family", "main", F.ceil((F.col("all") - F.col("most")) / PART).alias("outer"),
                     F.ceil(F.col("all") / PART).alias("inner")))
    held = materialize(held.join(sizes, "family"), "families")
    rows = (docs.select("doc_id", "text")
            .join(broadcast_within(held, count_up_to(held, BROADCAST_ROWS)), "doc_id")
            .withColumn("at", F.xxhash64("doc_id")))
    left = (rows.filter("component != main")
            .withColumn("i", F.pmod("at", "outer").cast("int"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("inner").cast("int") - 1)))
            .select("family", "i", "j", "doc_id", "component", "text"))
    right = (rows.withColumn("j", F.pmod("at", "inner").cast("int"))
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("outer").cast("int") - 1)))
             .select(*[F.col(c).alias(f"o_{c}") for c in
                       ("family", "i", "j", "doc_id", "component", "text")]))

    def compare(key, mine, others):
        found = []
        if mine.num_rows and others.num_rows:
            names, row = distinct_shingles(Words(others.column("o_text"), lower=True), width)
            ids = others.column("o_doc_id").to_numpy()
            comp = others.column("o_component").to_numpy()
            size = np.bincount(row, minlength=len(ids))
            order = np.argsort(names, kind="stable")
            names, row = names[order], row[order]
            known, first = np.unique(names, return_index=True)
            stop = np.append(first[1:], len(names))
            own, at = distinct_shingles(Words(mine.column("text"), lower=True), width)
            cuts = np.searchsorted(at, np.arange(mine.num_rows + 1))
            for k, (doc, label) in enumerate(zip(mine.column("doc_id").to_pylist(),
                                                 mine.column("component").to_pylist(), strict=True)):
                part = own[cuts[k]:cuts[k + 1]]
                place = np.searchsorted(known, part)
                place = np.minimum(place, len(known) - 1)
                place = place[known[place] == part]
                each = stop[place] - first[place]
                take = np.arange(each.sum()) + np.repeat(first[place] - (np.cumsum(each) - each),
                                                         each)
                common = np.bincount(row[take], minlength=len(ids))
                near = np.flatnonzero((den * common >= num * (len(part) + size - common))
                                      & (comp != label))
                _, once = np.unique(comp[near], return_index=True)
                found += [(doc, int(x)) for x in ids[near[once]]]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return (left.groupBy("family", "i", "j").cogroup(right.groupBy("o_family", "o_i", "o_j"))
            .applyInArrow(compare, "a long, b long"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2
    THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
    WHEN len(w) = 1 THEN [w[1]] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common >= 80 * (p.n + q.n - common)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id,
       min(r.y) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.x = d.doc_id
GROUP BY d.doc_id
"""
