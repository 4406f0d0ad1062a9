import random
import re

import numpy as np

from lexharbor.llm import neardup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    w = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def brute(rows, width, num=80, den=100):
    ids = [d for d, _ in rows]
    first = {d: min(t or "" for e, t in rows if e == d) for d in ids if d is not None}
    sets = [shingles(t if d is None else first[d], width) for d, t in rows]
    own = [shingles(t, width) for _, t in rows]
    of = list(range(len(rows)))

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            union = len(sets[i]) + len(sets[j]) - both
            alike = sets[i] and den * both >= num * union
            if None not in (ids[i], ids[j]) and (ids[i] == ids[j] or alike):
                of[root(i)] = root(j)
    out = []
    for i, d in enumerate(ids):
        least = min((ids[k] for k in range(len(rows)) if root(k) == root(i) and ids[k] is not None),
                    default=None)
        of_d = None if d is None else least
        out.append((d, len(own[i]), of_d, d is None or of_d == d))
    return sorted(out, key=str)


def families(seed, copies=60):
    """Chains of copies around the threshold, exact copies, and texts of one or no word."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    rows, base = [], [rng.choice(vocabulary) for _ in range(120)]
    for i in range(copies):
        text = list(base if i % 2 else rows and rows[-1][1].split() or base)
        for _ in range(rng.choice([0, 1, 2, 4, 7])):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((i * 7 % 401, " ".join(text)))
    rows += [(500 + i, " ".join(rng.choice(vocabulary) for _ in range(80))) for i in range(20)]
    return rows + [(600, None), (601, ""), (602, "One"), (603, "one"), (604, " \n"), (None, rows[0][1]),
                   (605, "a b c d " * 3000), (606, "A b c d " * 3000), (607, "a b"), (607, "a b"),
                   (608, rows[3][1]), (608, "zz yy xx"), (609, rows[4][1]), (609, None)]


def test_components_equal_brute_force(make):
    rows = families(1)
    for width in (2, 5):
        got = neardup.near_duplicates(make(rows), width).collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, width)


def test_empty_table(make):
    assert neardup.near_duplicates(make([])).collect() == []
    assert {tuple(r) for r in neardup.near_duplicates(make([(1, None)])).collect()} == {
        (1, 0, 1, True)}


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 2 ** 63, (2, 900), dtype=np.uint64)
    b[:600] = a[:600]
    ra, rb = (neardup.sketch(np.sort(x), np.zeros(900, int), 1) for x in (a, b))
    union = np.unique(np.concatenate([a, b]))
    assert (np.maximum(ra, rb) == neardup.sketch(union, np.zeros(len(union), int), 1)).all()
    j = neardup.likely_similarity(ra, rb, np.array([900]), np.array([900]))[0]
    assert abs(j - 0.5) < 0.12
    assert neardup.likely_similarity(ra, ra, np.array([900]), np.array([900]))[0] == 1
