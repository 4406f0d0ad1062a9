import random

from lexharbor.llm import components as C


def least_reached(links):
    of = {}

    def root(x):
        while of.setdefault(x, x) != x:
            x = of[x]
        return x

    for a, b in links:
        if a != b:
            low, high = sorted((root(a), root(b)))
            of[high] = low
    return {x: root(x) for x in of}


def test_components_equal_brute_force(spark):
    rng = random.Random(7)
    chain = [(i, i + 1) for i in range(-20, 20)]
    star = [(200, 100 + i) for i in range(60)] + [(300 + i, 250) for i in range(40)]
    comb = [(1000 + rng.randrange(60), 1000 + rng.randrange(60)) for _ in range(45)]
    rows = chain + star + comb + [(b, a) for a, b in star[:9]] + star[:5] + [(5000, 5000)]
    rng.shuffle(rows)
    got = C.components(spark.createDataFrame(rows, "a long, b long").repartition(3)).collect()
    assert {r.node: r.component for r in got} == least_reached(rows) and len(got) == len(least_reached(rows))


def test_no_links(spark):
    assert C.components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def test_a_round_reads_only_links_between_what_is_apart(spark, monkeypatch):
    """A group of many shelves: all links are read once, later rounds read far fewer."""
    rng = random.Random(8)
    rows = list({(rng.randrange(i), i) for i in range(1, 300) for _ in range(20)})
    sizes, write = [], C.materialize

    def noted(df, label):
        out = write(df, label)
        if label == "links":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(C, "materialize", noted)
    got = C.components(spark.createDataFrame(rows, "a long, b long")).collect()
    assert {r.component for r in got} == {0} and len(got) == 300
    assert sum(sizes) <= 1.2 * len(rows)
