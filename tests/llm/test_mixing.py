import collections
import random

from lexharbor.llm import mixing


def water(totals, weights, share=1.5, epochs=2.0):
    caps = {s: epochs * n for s, n in totals.items()}
    whole, open_ = share * sum(totals.values()), set(totals)
    while True:
        level = (whole - sum(caps[s] for s in totals if s not in open_)) / max(
            sum(weights[s] for s in open_), 1e-9)
        over = {s for s in open_ if caps[s] <= level * weights[s]}
        if not over:
            return {s: level * weights[s] if s in open_ else caps[s] for s in totals}
        open_ -= over


def test_targets_and_takings(make):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * 1 for _ in range(rng.randrange(60))), rng.choice(["a", "b", "ß", None, "hot", "hot", "hot"]))
            for i in range(400)]
    rows += [(1000, None, "nothing"), (1001, "", "nothing"), (None, "x y z", "a"), (5, "t t", "b"),
             (5, "t t", "b"), (2000, "w " * 3000, "hot")]
    got = mixing.mix(make(rows)).collect()
    again = mixing.mix(make(rows)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(got) == len(rows)
    totals = collections.Counter()
    for _, text, source in rows:
        totals[source] += len((text or "").split())
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    targets = water(totals, {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(order)})
    taken, largest = collections.Counter(), collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.repeats
        assert r.source_size == totals[r.source]
        assert abs(r.target - targets[r.source]) < 1e-6
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in totals:
        assert abs(taken[s] - targets[s]) <= max(largest[s] / 2, 1), (s, taken[s], targets[s])
    other = mixing.mix(make(rows), seed=8).collect()
    assert sorted(map(str, got)) != sorted(map(str, other))


def test_empty_table(make):
    assert mixing.mix(make([])).collect() == []
    assert [r.taken for r in mixing.mix(make([(1, None)])).collect()] == [0]
