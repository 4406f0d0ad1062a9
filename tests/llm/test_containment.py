import random

from lexharbor.llm import containment


def test_equals_brute_force(spark, make):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(40)]
    items += [(50, None), (51, ""), (None, "w1 w2 w3 w4 w5 w6"), (52, "one two"), (52, "w1 w2 w3 w4 w5")]
    rows = [(100, None), (101, ""), (102, "ONE Two"), (None, items[3][1]), (103, "w1 " * 20000)]
    for d in range(60):
        item = rng.choice(items[:40])[1].split()
        cut = rng.randrange(max(1, len(item) // 4))
        body = [rng.choice(words) for _ in range(rng.randrange(200))]
        text = body[:50] + item[cut:] + body[50:]
        rows.append((d, " ".join(text).upper() if d % 3 == 0 else "\n".join(text)))
    rows.append((5, items[7][1]))
    table = spark.createDataFrame([(*i, 1, "x") for i in items],
                                  "item_id long, text string, part int, name string")
    got = {(r.doc_id, r.item_id): (r.n_item, r.n_shared)
           for r in containment.contained_items(make(rows), table).collect()}
    want = {}
    for d, t in rows:
        for i, x in items:
            s = containment.spelled(x or "")
            own = containment.spelled(t or "", min(5, len((x or "").split())))
            if s and i is not None and 100 * len(s & own) >= 80 * len(s):
                found = (len(s), len(s & own))
                want[d, i] = max(want.get((d, i), found), found)
    assert got == want
    assert len(got) > 20 and (102, 52) in got and (None, items[3][0]) in got


def test_short_items_are_found_inside_texts(spark, make):
    table = spark.createDataFrame([(1, "Capital of France"), (2, "x"), (3, "of France is Paris"),
                                   (4, "a b c d e f"), (5, "no such thing")],
                                  "item_id long, text string")
    docs = make([(1, "The capital OF france is Paris"), (2, "capital of\nFrance"), (3, "of France"),
                 (4, "y x z " * 3000), (5, "x"), (6, "a b c d e f"), (7, "a b c d")])
    got = {(r.doc_id, r.item_id) for r in containment.contained_items(docs, table).collect()}
    assert got == {(1, 1), (1, 3), (2, 1), (4, 2), (5, 2), (6, 4)}


def test_empty_tables(spark, make):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert containment.contained_items(make([]), items).collect() == []
    assert containment.contained_items(make([(1, "a b c d e f")]), items.limit(0)).collect() == []
