import functools
import hashlib
import re

import numpy as np
import pyarrow as pa

from lexharbor.llm import repeats, substrings
from lexharbor.llm.repeats import Stretches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWEST = -(2 ** 63)


def by_words(rows, width=20):
    """Kept words of each row; a window counts if its words start earlier in (id, place)."""
    first = {}
    for doc, text in rows:
        w = WORD.findall(text or "")
        for s in range(len(w) - width + 1):
            key, at = tuple(w[s:s + width]), (LOWEST if doc is None else doc, s)
            first[key] = min(first.get(key, at), at)
    out = []
    for doc, text in rows:
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            if first[tuple(w[s:s + width])] < (LOWEST if doc is None else doc, s):
                gone[s:s + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def by_bytes(rows, width=50):
    first = {}
    for doc, text in rows:
        t, doc = (text or "").encode(), LOWEST if doc is None else doc
        for s in range(len(t) - width + 1):
            first[t[s:s + width]] = min(first.get(t[s:s + width], doc), doc)
    out = []
    for doc, text in rows:
        t = (text or "").encode()
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - width + 1):
            if first[t[s:s + width]] < (LOWEST if doc is None else doc):
                gone[s:s + width] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((doc, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_words_equal_brute_force(make, mixed_rows):
    got = substrings.remove_repeated_words(make(mixed_rows)).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == by_words(mixed_rows)


def test_bytes_equal_brute_force(make, mixed_rows):
    got = substrings.remove_repeated_bytes(make(mixed_rows)).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == by_bytes(mixed_rows)


def test_many_blocks_equal_brute_force(make, mixed_rows, monkeypatch):
    """Blocks of a few documents; texts without an id, or of one id, are spread over them."""
    monkeypatch.setattr(repeats, "in_blocks",
                        functools.partial(repeats.in_blocks, block_bytes=1500))
    rows = mixed_rows + [(None, f"{i} " + t) for i, (_, t) in enumerate(mixed_rows) if t]
    rows += [(6, t + f" {i}") for i, (_, t) in enumerate(mixed_rows[20:40])]
    rows = [(d, t[:600] if t else t) for d, t in rows]
    blocks = repeats.in_blocks(make([r for r in rows if r[0] in (None, 6)]).select("doc_id", "text"))[0]
    assert blocks.select("block").distinct().count() > 5
    got = substrings.remove_repeated_words(make(rows)).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == by_words(rows)
    got = substrings.remove_repeated_bytes(make(rows)).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == by_bytes(rows)


def test_empty_table(make):
    assert substrings.remove_repeated_words(make([])).collect() == []
    assert substrings.remove_repeated_bytes(make([])).collect() == []


def test_equal_windows_choose_the_same_anchor():
    rng = np.random.default_rng(1)
    shared = [str(x) for x in rng.integers(0, 3, 50)]
    texts = [" ".join([str(x) for x in rng.integers(0, 3, n)] + shared +
                      [str(x) for x in rng.integers(0, 3, 7)]) for n in range(30)]
    docs = pa.table({"doc_id": list(range(30)), "text": texts})
    for parse, width in ((substrings.parse_words, 20), (substrings.parse_bytes, 50)):
        p = parse(docs)
        s = Stretches(p, np.arange(30), True, 63)
        seen = {}
        start, own = s.windows(np.arange(len(s.first)))
        for at, k in zip(start.tolist(), own.tolist()):
            found = (int(s.at[k]) - at, int(s.core[k]))
            assert seen.setdefault(int(p.name[at]), found) == found
