import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lexharbor.llm import toxicity


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("an", "er", "on", "ing", "é")]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(3, 60))]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(2):
                text[rng.randrange(len(text))] = rng.choice(["Vile!", "nasty,", "NASTYLY***"])
        rows.append((i, " ".join(text), int(bad), "en" if i % 3 else "de"))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = corpus()
    return toxicity.fit([t for _, t, _, _ in rows], np.array([y for *_, y, _ in rows]),
                        [lang for *_, lang in rows])


def test_held_out_accuracy(model):
    rows = corpus(300, seed=2)
    score = model.scores(pa.array([t for _, t, _, _ in rows]))
    y = np.array([r[2] for r in rows])
    assert ((score >= 0.3) == y).mean() > 0.95
    assert {"*", "en", "de"} <= set(model.thresholds)


def test_scores_do_not_depend_on_the_batch(model):
    texts = ["", "vile", " ", "a" * 50000, "lan " * 20000 + "nasty", "lan", "!!!"]
    together = model.scores(pa.array(texts))
    alone = [model.scores(pa.array([t]))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-6)
    assert (together >= 0).all() and (together <= 1).all()


def test_gradient_of_the_filters():
    rng = np.random.default_rng(0)
    texts = ["one two three", "two", "four one nasty"]
    m = toxicity.Model(rng.normal(0, 0.3, (toxicity.BUCKETS + 1, toxicity.SIZE)).astype(np.float32),
                       [rng.normal(0, 0.3, (w, toxicity.SIZE, toxicity.FILTERS)).astype(np.float32)
                        for w in toxicity.WIDTHS],
                       [np.zeros(toxicity.FILTERS, np.float32) for _ in toxicity.WIDTHS],
                       rng.normal(0, 0.3, len(toxicity.WIDTHS) * toxicity.FILTERS).astype(np.float32))
    y = np.array([0.0, 1.0, 1.0])

    def loss():
        z = m.logits(*toxicity.features(pa.array(texts)))
        return float(np.mean(np.logaddexp(0, -z) * y + np.logaddexp(0, z) * (1 - y)))

    before = loss()
    for _ in range(20):
        toxicity._step(m, *toxicity.features(pa.array(texts)), y, {
            "table": np.full(toxicity.BUCKETS + 1, 1e-2, np.float32)})
    assert loss() < before


def test_rows_and_held_out_ids(spark, make, model):
    rows = corpus(200)
    docs = make([(i, t, "s", lang) for i, t, _, lang in rows] + [(None, None), (7, "twice"), (900, "")])
    labels = spark.createDataFrame([(i, y) for i, _, y, _ in rows] + [(1, None), (None, 1), (2, 1)],
                                   "doc_id long, toxic int")
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == 203
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    assert toxicity.score(make([]), model).collect() == []
    assert toxicity.scored(docs, labels.limit(0)).count() == 203
