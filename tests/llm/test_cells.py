import hashlib
import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lexharbor.llm import cells

SCHEMA = ("vec_id long, embedding array<float>, label int, code string, w long, g int, of int, "
          "slot int, error long")
EXTRA = ("x", 1, 2, 3, 4, 5)


def brute(rows, parts, entries, rounds, scale=1024):
    """The contract in plain Python, whole numbers throughout."""
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    width = max((len(v) for _, v, _ in kept), default=0)
    step = -(-width // parts)
    cut = [[(v + [0] * (step * parts - len(v)))[p * step:(p + 1) * step] for p in range(parts)]
           for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e)
                   for e, c in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            of = [near(c[p], book)[1] for c in cut]
            books[p] = [[sum(col) // len(mine) for col in zip(*mine, strict=True)] if mine else old
                        for mine, old in (([c[p] for c, o in zip(cut, of, strict=True) if o == e], old)
                                          for e, old in enumerate(book))]
    out, by_label = [], {}
    for (i, _, label), c in zip(kept, cut, strict=True):
        best = [near(c[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in best), error, label))
    text = ",".join(str(x) for b in books for e in b for x in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, c, e, by_label[label], sha) for i, c, e, label in out), key=repr)


def got(spark, rows, **how):
    made = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in cells.quantize(made, **how).collect()), key=repr)


def as_floats(rows):
    return [(i, v and [x if x is None else float(np.float32(x)) for x in v], label)
            for i, v, label in rows]


def test_codes_equal_plain_computation(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(12)], rng.choice([1, 2, None]))
            for i in range(150)]
    rows += [(200 + i, rows[i % 5][1], 3) for i in range(60)]
    rows += [(300, None, 1), (301, [0.1] * 11 + [None], 1), (302, [float("nan")] * 12, 1),
             (303, [float("inf")] + [0.0] * 11, None), (None, [0.25] * 12, None), (304, [-0.5] * 12, 4)]
    rows = as_floats(rows)
    assert got(spark, rows, entries=16) == brute(rows, 4, 16, 4)
    # fewer vectors than entries, and no rounds
    assert got(spark, rows[:7], entries=16, rounds=0) == brute(rows[:7], 4, 16, 0)


def test_short_vectors_huge_components_and_empty_tables(spark):
    rows = as_floats([(1, [0.5, 1.0, -2.0, 3.0, 0.1], 1), (2, [0.5, 1.0], 1), (3, [], None),
                      (4, [1e9, -1e9, 3e8, 0.0, 1.0], 2), (5, [1e9, -1e9, 3e8, 0.5, 1.0], 2)])
    assert [r[:2] for r in got(spark, rows, entries=3)] == \
        [r[:2] for r in brute(rows, 4, 3, 4)]
    assert all(0 <= r[2] <= cells.LONG_MAX for r in got(spark, rows, entries=3))
    assert got(spark, []) == []
    assert got(spark, [(1, None, 1)]) == []
    assert [r[1:4] for r in got(spark, [(1, [], 1), (1, [], 1)])] == [("00000000", 0, 0)] * 2


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 40), st.integers(1, 5), st.sampled_from([3, 50, 4000]))
def test_pruned_search_finds_the_nearest_and_lowest(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    book = rng.integers(-spread, spread, (rng.integers(1, 30), dim))
    vectors = rng.integers(-2 * spread, 2 * spread, (n, dim))
    number, distance = cells.Codebook(book).nearest(vectors)
    exact = ((vectors[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert number.tolist() == exact.argmin(axis=1).tolist()
    assert distance.tolist() == exact.min(axis=1).tolist()
    wide = cells.Codebook(book.astype(object)).nearest(vectors.astype(object))
    assert wide[0].tolist() == number.tolist() and list(wide[1]) == distance.tolist()


def test_cells_are_remembered_and_dominated_entries_skipped(monkeypatch):
    rng = np.random.default_rng(5)
    book = cells.Codebook(rng.integers(-300, 300, (256, 2)))
    vectors = rng.integers(-300, 300, (3000, 2))
    number, _ = book.nearest(vectors)
    assert max(len(f) for f in book.memo.values()) < 64
    asked = []
    monkeypatch.setattr(cells.Codebook, "_bounds", lambda self, c: asked.append(c))
    assert book.nearest(vectors)[0].tolist() == number.tolist() and not asked
