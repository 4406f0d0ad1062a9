import itertools
import random
import re

import numpy as np
import pytest

from lexharbor.llm import pii

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = (True, all(int(p) <= 255 for p in m.group().split(".")) if kind == 1 else True,
                  16 <= len(digits) <= 19 and pii.luhn(digits), 8 <= len(digits) <= 15)[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_equals_the_plain_patterns():
    rng = random.Random(1)
    for _ in range(20000):
        text = "".join(rng.choice("a1 @.-+_()%9é\n") for _ in range(rng.randrange(30)))
        assert pii.base_spans(text) == brute(text), text
    card = "4111 1111 1111 1111"
    assert pii.base_spans(f"x {card} y") == [(2, 2, 21)]


def sample():
    rng = random.Random(2)
    out = []
    for i in range(60):
        ip = ".".join(str(rng.randrange(256)) for _ in range(4))
        phone = f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
        digits = "".join(str(rng.randrange(10)) for _ in range(15))
        card = next(digits + str(d) for d in range(10) if pii.luhn(digits + str(d)))
        out.append(f"one two a{i}.b@mail{i}.example.org and {ip} or {phone} of {card}. End 4.0.")
    return out


@pytest.fixture(scope="module")
def model():
    return pii.fit(sample())


def found(text, model):
    return [(pii.KINDS[k], text[a:b]) for k, a, b in pii.all_spans(text, model)[1]]


def test_field_adds_other_spellings_and_leaves_near_misses(model):
    assert found("to jo.b[at]mail7[dot]example[dot]org now", model) == [
        ("email", "jo.b[at]mail7[dot]example[dot]org")]
    assert found("ring (235) 555-2058 soon", model) == [("phone", "(235) 555-2058")]
    assert found("at 10.0.0.300 or id 9807915762804491 or v 4.0.", model) == []
    assert found("nothing here at all", model) == []


def test_base_spans_always_stay(make, model):
    texts = [*sample()[:5], "", "1" * 5000, "a@" * 500, "long " * 20000 + "x@y.zz", "+1 22 33 44"]
    docs = make([(i, t) for i, t in enumerate(texts)] + [(77, None), (None, "q@r.st"), (0, texts[0])])
    rows = pii.find(docs, model).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        base = {(pii.KINDS.index(s.kind), s.start, s.end) for s in r.spans if s.base}
        assert base == set(brute(r.text))
    d = {r.doc_id: r for r in pii.digest(pii.find(docs, model)).collect()}
    assert d[77].spans == "" and d[None].n_email == 1 and d[None].spans == "email:0:6"
    assert pii.find(make([]), model).collect() == []


def labellings(region):
    """Every segmentation of a region: lists of (segment number, kind) in order of place."""
    def after(at):
        if at == len(region.plain):
            yield []
            return
        for rest in after(at + 1):
            yield rest
        for k, (i, j, _) in enumerate(region.segments):
            if i == at:
                for kind, rest in itertools.product(range(len(pii.KINDS)), list(after(j))):
                    yield [(k, kind), *rest]
    return list(after(0))


def score_of(model, region, labels):
    o, s = model.potentials(region)
    starts = {region.segments[k][0]: (k, kind) for k, kind in labels}
    at, before, total, last = 0, len(pii.KINDS), 0.0, len(pii.KINDS)
    while at < len(region.plain):
        if at in starts:
            k, kind = starts[at]
            total += model.steps[before, kind] + s[k][kind]
            at, before = region.segments[k][1], kind
        else:
            total += model.steps[before, last] + o[at]
            at, before = at + 1, last
    return total


def test_best_and_likelihood_equal_enumeration():
    """The dynamic programs against all segmentations of small regions, with random weights."""
    rng = np.random.default_rng(4)
    seen = 0
    for text in ("a@b", "x 12 y", "+1 2", "7.8", "a1 b2", "q (3)", "1-2@c"):
        names = pii.Names()
        found = list(pii.regions(text, names))
        for r in found:
            every = labellings(r)
            assert len(every) > 4
            m = pii.SemiMarkov(names, *(rng.normal(size=s) for s in (
                (len(names), 4), len(names), (5, 5))))
            scores = np.array([score_of(m, r, x) for x in every])
            top = every[int(scores.argmax())]
            assert m.best(r) == [(kind, r.bounds[r.segments[k][0]], r.bounds[r.segments[k][1]])
                                 for k, kind in top], text
            gold = every[len(every) // 2]
            r.gold = [k * len(pii.KINDS) + kind for k, kind in gold]
            grads = [np.zeros_like(w) for w in (m.kinds, m.plain, m.steps)]
            value = m.gradient(r, *grads)
            whole = np.logaddexp.reduce(scores)
            assert abs(value - (score_of(m, r, gold) - whole)) < 1e-8
            step = 1e-6
            for w, g in zip((m.kinds, m.plain, m.steps), grads, strict=True):
                for at in [tuple(rng.integers(0, d) for d in w.shape) for _ in range(4)]:
                    w[at] += step
                    up = score_of(m, r, gold) - np.logaddexp.reduce([score_of(m, r, x) for x in every])
                    w[at] -= step
                    assert abs((up - value) / step - g[at]) < 1e-3
            seen += 1
    assert seen >= 6


def test_ties_and_small_samples_leave_plain_text():
    names = pii.Names()
    region = next(pii.regions("call 555 1234 or 12 3", names))
    zero = pii.SemiMarkov(names, np.zeros((len(names), 4)), np.zeros(len(names)), np.zeros((5, 5)))
    assert zero.best(region) == []
    bare = pii.fit([])
    assert found("at 12 3 of 555 1234 parts", bare) == []
    assert found("to jo.b[at]mail7[dot]example[dot]org now", bare) == [
        ("email", "jo.b[at]mail7[dot]example[dot]org")]


def test_sample_holds_every_kind_and_copies_once(make):
    """A kind of one text among thousands is drawn; a text that fills half the table is one text."""
    rare = sample()[0]
    rows = [(i, f"chapter {i} of 12") for i in range(400)] + [(1000 + i, rare) for i in range(400)]
    rows += [(2000 + i, f"user{i}@host{i}.example.org wrote") for i in range(400)]
    drawn = []
    keep, pii.fit = pii.fit, drawn.extend
    try:
        pii.train(make(rows), rows=40)
    finally:
        pii.fit = keep
    assert drawn.count(rare) == 1 and 2 <= len(drawn) <= 40
    assert not any(t.startswith("chapter") for t in drawn)
