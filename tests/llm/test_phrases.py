import hashlib

from lexharbor.llm import phrases


def test_edited_texts_and_fingerprints(make, mixed_rows):
    rows = sorted(((d is not None, d or 0, t or "") for d, t in mixed_rows))
    got = phrases.edited_fingerprints(make(mixed_rows), range_bytes=3000).collect()
    assert len(got) == len(rows)
    want = []
    for k, (known, d, t) in enumerate(rows):
        follow = rows[(k + 1) % len(rows)][2]
        half = len(t) // 2
        new = t[:len(t) - half] + follow[:half]
        own, edited, nxt = (phrases.parsed(x)[None] for x in (t, new, follow))
        want.append((d if known else None, len(t), hashlib.sha256(new.encode()).hexdigest(),
                     phrases.written(own[0]), phrases.written(edited[0]),
                     float(phrases.likeness(own, edited)[0]), float(phrases.likeness(own, nxt)[0])))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_phrases_of_a_text():
    p = phrases.Phrases().read("abababab", 0, 8)
    assert p.known == {"a", "b", "ab", "aba"} and p.ends == [1, 2, 4, 7]
    assert phrases.written(phrases.parsed("")) == "-" * 4 * phrases.PLACES
    assert phrases.likeness(phrases.parsed("")[None], phrases.parsed("")[None])[0] == 1


def test_fingerprints_alone(make):
    got = phrases.fingerprints(make([(1, "abc abc"), (2, "abc abc"), (3, None)])).collect()
    found = {r.doc_id: r.fingerprint for r in got}
    assert found[1] == found[2] != found[3]
    assert phrases.edited_fingerprints(make([])).collect() == []
    alone = phrases.edited_fingerprints(make([(1, "abcd")])).collect()[0]
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone.near_next == 1
