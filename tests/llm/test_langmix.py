import random
import zlib

import numpy as np
import pytest

from lexharbor.llm import langmix

PARTS = {"de": ["der", "ung", "sch", "ein", "keit", "über"], "en": ["the", "ing", "tion", "er", "and", "wh"],
         "es": ["ción", "ado", "que", "los", "ñar", "ez"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(PARTS[lang], k=rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(1)
    return [(i, text(rng, lang, rng.randrange(5, 60)), "s", lang)
            for i, lang in enumerate(rng.choices(list(PARTS), k=300))]


@pytest.fixture(scope="module")
def model(spark, labelled):
    frame = spark.createDataFrame([(t, lang) for _, t, _, lang in labelled], "text string, lang string")
    return langmix.train(frame)


def test_shares_equal_a_search_over_all_shares(model):
    """The mixture's shares are those of greatest likelihood, found by trying a grid of them."""
    rng = random.Random(5)
    for first, second in (("de", "en"), ("en", "es"), ("es", "es")):
        both = text(rng, first, 60) + " " + text(rng, second, 40)
        bucket, _ = langmix.gram_buckets([both], len(model.likelihood))
        found = model.likelihood[bucket].astype(float)
        steps = [(a / 40, b / 40) for a in range(41) for b in range(41 - a)]
        best = max(steps, key=lambda s: np.log(
            found @ np.array([s[0], s[1], 1 - s[0] - s[1]]) + 1e-300).sum())
        grid = dict(zip(model.langs, (best[0], best[1], 1 - best[0] - best[1]), strict=True))
        languages, _ = langmix.mixtures([both], model)[0]
        assert {lang for lang, _ in languages} == {first, second}
        for lang, share in languages:
            assert abs(share - grid[lang]) < 0.05
        assert abs(sum(s for _, s in languages) - 1) < 1e-6


def test_a_text_gets_the_same_languages_alone_and_among_others(model, labelled):
    texts = [t for _, t, _, _ in labelled] + ["", None, "1 2 3", "the", "ungkeit ction"]
    together = langmix.mixtures(texts, model)
    alone = [langmix.mixtures([t], model)[0] for t in texts]
    for (a, x), (b, y) in zip(together, alone, strict=True):
        assert [lang for lang, _ in a] == [lang for lang, _ in b] and abs(x - y) < 1e-3


def test_predictions_on_held_out_rows(spark, make, labelled):
    rows = labelled + [(1000, None, "s", "en"), (1001, "  12 ?! _", "s", "en"), (1002, "", "s", "de"),
                       (None, "the thing", "s", None), (7, "der und ein", "s", "de"),
                       (1003, "THE TION ING ERAND! " * 4000, "s", None), (1004, "²١", "s", "en")]
    found = langmix.predict(make(rows))
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    got = found.collect()
    assert len(got) == len(rows)
    at = {r["doc_id"]: r for r in got}
    right = [at[i]["lang_pred"] == lang for i, _, _, lang in labelled if at[i]["held_out"]]
    assert len(right) > 40 and sum(right) / len(right) >= 0.97
    for r in got:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == held and 0 <= r["score"] <= 1
    assert all(at[i]["lang_pred"] == "und" and at[i]["score"] == 0 for i in (1000, 1001, 1002, 1004))
    assert at[None]["lang_pred"] == at[1003]["lang_pred"] == "en"
    shown = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langmix.predict(make(rows)).collect()}
    assert shown == {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}


def test_labels_of_held_out_rows_are_never_read(make, labelled):
    wrong = [(i, t, s, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang)
             for i, t, s, lang in labelled]
    one, other = langmix.predict(make(labelled)), langmix.predict(make(wrong))
    key = ["doc_id", "lang_pred", "score"]
    assert sorted(map(tuple, one.select(*key).collect())) == \
        sorted(map(tuple, other.select(*key).collect()))


def test_nothing_to_learn_from(make):
    assert langmix.predict(make([])).count() == 0
    got = langmix.predict(make([(1, "the", "s", None), (2, None, "s", "en")])).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 2
