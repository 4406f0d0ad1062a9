import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lexharbor.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = np.random.default_rng(1).integers(1, 2 ** 63, 50, dtype=np.uint64)


def brute(words, least=12):
    """Every lag, every diagonal, one word after the other."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i - q, j), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


blocks = st.recursive(
    st.lists(st.integers(0, 2), min_size=1, max_size=4),
    lambda inner: st.one_of(
        st.tuples(inner, st.integers(1, 6)).map(lambda x: x[0] * x[1]),
        st.tuples(inner, inner).map(lambda x: x[0] + x[1]),
        st.tuples(inner, inner).map(lambda x: x[0] + x[1] + x[0])), max_leaves=12)


@settings(max_examples=400, deadline=None)
@given(blocks)
def test_runs_equal_every_diagonal(words):
    words = words[:400]
    assert runs.maximal_runs(NAMES[np.array(words)]) == brute(words)


def test_texts_of_two_words_and_long_repeats():
    rng = random.Random(2)
    for n in (0, 1, 11, 12, 60, 400):
        words = [rng.randrange(2) for _ in range(n)]
        assert runs.maximal_runs(NAMES[np.array(words, dtype=int)]) == brute(words)
    fib, nxt = [0], [0, 1]
    while len(nxt) < 300:
        fib, nxt = nxt, nxt + fib
    assert runs.maximal_runs(NAMES[np.array(nxt)]) == brute(nxt)
    one = np.repeat(NAMES[:1], 300_000)
    assert runs.maximal_runs(one) == [(0, 300_000, 1)]
    # a long run, a word, the same long run: quadratic if every earlier occurrence were followed
    assert len(runs.maximal_runs(np.concatenate([one, NAMES[1:2], one, NAMES[1:2], one]))) == 4


def expected(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(found), *top, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


def test_digest_equals_plain_computation(spark, make, mixed_rows):
    rng = random.Random(7)
    rows = mixed_rows + [(1000 + i, " ".join(rng.choice(["a", "b", "漢字", "x y"])
                                             for _ in range(rng.randrange(60)))) for i in range(80)]
    rows += [(5000, "\x1f".join(["a"] * 30) + "  \x0b b " * 20), (5001, "w " * 5000)]
    found = runs.digest(runs.find_runs(runs.with_repeated_tails(make(rows))))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                             "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == \
        sorted((expected(*r) for r in rows), key=repr)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[0] is not None)
    assert runs.digest(runs.find_runs(make([]))).count() == 0


def test_slices_keep_every_row_and_long_texts_alone(spark, make):
    rows = [(i, "a b " * 50) for i in range(9)] + [(10, "c d " * 500), (11, None), (12, "")]
    batch = make(rows).select("doc_id", "text").coalesce(1).toArrow().combine_chunks().to_batches()[0]
    pieces = list(runs.slices(batch, 450))
    assert sum(len(p) for p in pieces) == len(batch)
    assert all(len(p) == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 450
               for p in pieces)
