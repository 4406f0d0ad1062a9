import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, block int, core long, "
          "name string, part int, score double, n int, spans string, gone_id int")
EXTRA = (1, 2, "x", 3, 0.5, 4, "y", 5)


def row(doc_id, text, source="s", lang="en"):
    return (doc_id, text, lang, source, len(text or ""), *EXTRA)


@pytest.fixture(scope="session")
def make(spark):
    """Documents with extra columns whose names clash with those used inside."""
    def made(rows):
        return spark.createDataFrame([row(*r) for r in rows], SCHEMA).repartition(3)
    return made


@pytest.fixture(scope="session")
def mixed_rows():
    """Null, empty, tiny and very long texts, copies, ties, passages shared at many places."""
    rng = random.Random(4)
    words = ["the", "of", "é́a", "run", "x", "漢字", "and", "to"]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, other = text(60), text(31)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, passage), (5, text(9) + " " + passage),
            (6, passage), (6, passage), (7, text(3000)), (8, "run " * 70),
            (9, other + "\n" + text(5)), (10, text(3) + " " + other), (11, "one"),
            (12, passage.replace(" ", "\n")), (None, other), (None, None), (-3, other),
            (2 ** 40, "a" * 4000), (2 ** 40 + 1, "b" + "a" * 200)]
    rows += [(100 + i, text(rng.randrange(40)) + " " + rng.choice([passage, other])[:rng.randrange(300)])
             for i in range(40)]
    return rows
