import math
import random

import pytest
from pyspark.sql import functions as F

from lexharbor.operators import lookup, ranking, snippets
from lexharbor.operators.analysis import DEFAULT, PLAIN, STANDARD, Registry
from lexharbor.operators.suggest import suggest_terms
from lexharbor.plans import search as S
from lexharbor.plans.index import build_index
from lexharbor.plans.search import search
from lexharbor.plans.snapshot import Snapshots


@pytest.fixture(scope="module")
def found(corpus, asked):
    return search(build_index(corpus, DEFAULT), asked, 10, details=True)


def test_hits_of_the_small_corpus(found):
    hits = {}
    for r in found.hits.orderBy("query_id", "rank").collect():
        hits.setdefault(r.query_id, []).append(r.path.rsplit("/", 1)[-1])
    assert hits == {1: ["king.txt", "king.of.france.txt"], 2: ["king.of.france.txt"],
                    3: ["king.txt"], 4: ["king.of.france.txt", "king.txt"],
                    5: ["king.txt", "king.of.france.txt"]}
    assert {r.query_id: r.n_hits for r in found.counts.collect()} == {1: 2, 2: 1, 3: 1, 4: 2, 5: 2}
    assert [r.query_id for r in found.rejected.collect()] == [7]


def test_snippets_of_the_small_corpus(found):
    got = {(r.query_id, r.path): r.text for r in found.snippets.collect()}
    assert got[1, "/c/a/king.txt"] == "The <b>king</b> of France met the queen."
    assert got[3, "/c/a/king.txt"] == "The king of <b>France</b> <b>met</b> the queen."
    assert got[4, "/c/ab/king.of.france.txt"] == "A <b>queen</b> and a <b>queen</b>."
    assert got[5, "/c/a/king.txt"] is None and got[2, "/c/ab/king.of.france.txt"] is None


def test_number_of_expansions_and_fragments_shown(spark):
    docs = spark.createDataFrame([("/1", "fr", "", "kings kinga king kina " + "filler words go on " * 9
                                   + "kings and again")], "path string, lang string, title string, body string")
    asked = spark.createDataFrame([(1, "fuzzy", "fr", "king")],
                                  "query_id int, kind string, lang string, text string")
    index = build_index(docs, PLAIN)
    few = search(index, asked, 5, details=True, expansions=1, best=1).snippets.collect()
    assert [r.text.count("<b>") for r in few] == [1]
    many = search(index, asked, 5, details=True).snippets.collect()
    assert sorted(r.text.count("<b>") for r in many) == [1, 4]


def test_score_of_one_term(corpus, asked):
    hits = search(build_index(corpus, PLAIN), asked.filter("query_id = 1"), kinds=["term"]).hits
    got = {r.path: r.score for r in hits.collect()}

    def part(n, df, tf, length, avg):
        idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
        return idf * tf / (tf + 1.2 * (0.25 + 0.75 * length / avg))

    title = 2 + 4 + 2
    assert got["/c/a/king.txt"] == pytest.approx(
        part(2, 1, 1, 4, 3.0) + part(3, 2, 1, 2, title / 3), abs=1e-9)


def test_gap_aware_phrase(corpus, asked):
    query = asked.filter("query_id = 2")
    hits = search(build_index(corpus, DEFAULT), query, kinds=["phrase"], gap_aware=True).hits
    assert {r.path for r in hits.collect()} == {"/c/a/king.txt", "/c/ab/king.of.france.txt"}


def test_limits(corpus, asked):
    index = build_index(corpus, PLAIN)
    one = search(index, asked, 1, kinds=["term", "prefix"])
    assert {(r.query_id, r.rank) for r in one.hits.collect()} == {(1, 1), (5, 1)}
    assert {r.query_id: r.n_hits for r in one.counts.collect()} == {1: 2, 5: 2}
    assert search(index, asked, 0, kinds=["prefix"]).hits.count() == 2
    with pytest.raises(ValueError):
        search(index, asked, -1)


def test_rank_all_equals_one_window(spark):
    hits = spark.range(3000).select(
        (F.col("id") % 3).alias("query_id"), F.concat(F.lit("p"), "id").alias("path"),
        F.when(F.col("id") % 3 == 0, F.lit(1.0)).otherwise((F.col("id") * 7919 % 50) / 7.0)
        .alias("score"))
    every = {(r.query_id, r.path): r["rank"] for r in ranking.rank_all(hits).collect()}
    plain = {(r.query_id, r.path): r["rank"] for r in ranking.top_k(hits, 10_000).collect()}
    assert every == plain


def osa(a, b):
    d = {(i, -1): i + 1 for i in range(-1, len(a))}
    d.update({(-1, j): j + 1 for j in range(-1, len(b))})
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_fuzzy_expansion_equals_brute_force(spark):
    rng = random.Random(7)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(1, 14))) for _ in range(500)}
    words |= {w[:1] + w[2:3] + w[1:2] + w[3:] for w in list(words)[:200]} | {"ca", "abc"}
    words = sorted(w for w in words if w)
    vocabulary = spark.createDataFrame([("en", "body", w, i) for i, w in enumerate(words)],
                                       "lang string, field string, term string, df long")
    asked = spark.createDataFrame([("en", "body", w) for w in words[::4] + ["ca"]],
                                  "lang string, field string, word string").distinct()
    got = {}
    for r in lookup.fuzzy_expand(vocabulary, asked).collect():
        got.setdefault(r.word, []).append((r["rank"], r.term, r.edits))
    for word in {r.word for r in asked.collect()}:
        near = [(osa(word, t), t) for t in words]
        near = [(-(1 - e / min(len(word), len(t))), t, e) for e, t in near
                if e <= 2 and e < min(len(word), len(t))]
        want = [(i + 1, t, e) for i, (_, t, e) in enumerate(sorted(near)[:50])]
        assert sorted(got.get(word, [])) == want, word


def test_fragments_equal_a_walk_over_the_words(spark):
    rng = random.Random(3)
    texts = [" ".join("x" * rng.choice([1, 3, 8, 8, 20, 200]) + rng.choice(["", ",", "  "])
                      for _ in range(rng.randint(0, 60))) for _ in range(40)]
    docs = spark.createDataFrame([(str(i), "xx", t) for i, t in enumerate(texts)],
                                 "path string, lang string, body string")
    cut = snippets.cut_bodies(docs, Registry(bound={}, fallback=STANDARD))
    got = {}
    for r in snippets.words_of_cut(cut).collect():
        got.setdefault(int(r.path), []).append((r.start, r.end, r.frag_no))
    spans = {}
    for r in snippets.fragments(cut).collect():
        spans.setdefault(int(r.path), []).append((r.frag_no, r.start, r.end))
    import re
    for i, text in enumerate(texts):
        n, started, want = 0, 1, []
        for k, m in enumerate(re.finditer("x+", text)):
            if k and m.end() >= 70 * started and len(text) - m.end() >= 35:
                n, started = n + 1, started + 1
            want.append((m.start(), m.end(), n))
        assert sorted(got.get(i, [])) == want
        if want:
            parts = sorted(spans[i])
            assert parts[0][1] == 0 and parts[-1][2] == len(text)
            assert all(a[2] == b[1] for a, b in zip(parts, parts[1:]))


def test_phrase_match_is_not_split(spark):
    docs = spark.createDataFrame([("p", "xx", "word " * 12 + "alpha beta " + "word " * 20)],
                                 "path string, lang string, body string")
    registry = Registry(bound={}, fallback=STANDARD)
    free = {r.pos: r.frag_no for r in snippets.words_of_cut(
        snippets.cut_bodies(docs, registry)).collect()}
    assert free[12] == 0 and free[13] == 1
    wall = spark.createDataFrame([("p", 13)], "path string, pos int")
    held = {r.pos: r.frag_no for r in snippets.words_of_cut(
        snippets.cut_bodies(docs, registry, blocked=wall)).collect()}
    assert held[12] == held[13] == 0 and held[14] == 1


def test_suggestions(spark):
    vocabulary = spark.createDataFrame([("king", 5), ("kind", 7), ("queen", 9)],
                                       "term string, df long")
    asked = spark.createDataFrame([("ki",), ("x",)], "prefix string")
    got = suggest_terms(vocabulary, asked, 1).collect()
    assert [(r.prefix, r.term, r["rank"]) for r in got] == [("ki", "kind", 1)]
    more = spark.createDataFrame([("in",), ("n",), ("ee",), ("",)], "prefix string")
    inside = suggest_terms(vocabulary, more, 2, inside=True).orderBy("prefix", "rank").collect()
    assert [(r.prefix, r.term) for r in inside if r.prefix] == [
        ("ee", "queen"), ("in", "kind"), ("in", "king"), ("n", "queen"), ("n", "kind")]


def test_lookups_open_only_the_folders_their_terms_fall_into(spark, tmp_path):
    words = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame(
        [(f"/d/{i}", "en" if i % 2 else "fr", "t", " ".join(words[i:i + 6])) for i in range(290)],
        "path string, lang string, title string, body string")
    store = Snapshots(spark, str(tmp_path / "index"), PLAIN, buckets=2, splits=2, slots=16)
    index = store.publish(docs)
    plain = build_index(docs, PLAIN)

    def asked(n):
        return spark.range(n).select(
            F.col("id").alias("query_id"), F.lit("term").alias("kind"), F.lit("en").alias("lang"),
            F.concat(F.lit("w"), F.col("id") * 7).alias("text"))

    for n in (1, 10, 10_000):
        hits = search(index, asked(n), kinds=["term"]).hits
        clauses = S.clause_hits(index, asked(n), ["term"])["term"]
        plan = clauses._jdf.queryExecution().executedPlan().toString()
        filters = next(line for line in plan.split("FileScan")[1:] if "positions" in line or "tf#" in line)
        pruned = filters.split("PartitionFilters:")[1].split("PushedFilters")[0]
        assert "slot#" in pruned and "lang#" in pruned
        assert "GreaterThanOrEqual(term" in filters
        reach = index.reach(S.term_clauses(S.analyze_queries(asked(n), PLAIN)))
        within = index.postings_within(reach).select("slot", "lang").distinct().collect()
        assert {r.slot for r in within} <= set(reach.slots) and {r.lang for r in within} <= {"en"}
        assert len(reach.slots) <= min(16, n)
        want = search(plain, asked(n), kinds=["term"]).hits
        assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, want.collect()))


def test_a_phrase_costs_its_rarest_terms_documents(spark, tmp_path):
    rows = [(f"/d/{i}", "fr", "", "le roi de la terre " * 3 + ("rare fin" if i % 50 == 0 else "fin rare "
             if i % 50 == 1 else "fin")) for i in range(400)]
    docs = spark.createDataFrame(rows, "path string, lang string, title string, body string")
    index = Snapshots(spark, str(tmp_path / "index"), PLAIN, buckets=2).publish(docs)
    asked = spark.createDataFrame([(1, "phrase", "fr", "de la terre rare fin"),
                                   (2, "phrase", "fr", "la terre absent"), (3, "phrase", "fr", "rare"),
                                   (4, "phrase", "fr", "terre le roi")],
                                  "query_id int, kind string, lang string, text string")
    clauses = S.phrase_clauses(S.analyze_queries(asked, PLAIN))
    per_query = {r.query_id: r.n for r in lookup.phrase_rows(index, clauses).groupBy("query_id")
                 .agg(F.count(F.lit(1)).alias("n")).collect()}
    # 16 documents hold the rarest word, so 16 rows for each of the five words
    assert per_query == {1: 16 * 5, 3: 16, 4: 400 * 3}
    hits = {(r.query_id, r.path): r.freq for r in lookup.phrase_hits(index, clauses).collect()}
    want = {(1, p): 1 for p, *_, body in rows if "terre rare fin" in body}
    want |= {(3, p): body.split().count("rare") for p, *_, body in rows if "rare" in body.split()}
    want |= {(4, p): body.count("terre le roi") for p, *_, body in rows}
    assert hits == want


def test_a_posting_is_joined_with_what_a_candidate_asks_of_it(spark):
    """Thirty phrases share a word of all documents; each is in one document by its rarest word."""
    docs = spark.createDataFrame([(f"/{i}", "fr", "", f"x common w{i} end x common") for i in range(30)],
                                 "path string, lang string, title string, body string")
    asked = spark.createDataFrame([(i, "phrase", "fr", f"common w{i} end x common") for i in range(30)],
                                  "query_id int, kind string, lang string, text string")
    index = build_index(docs, PLAIN)
    phrases = S.phrase_clauses(S.analyze_queries(asked, index.registry))
    rows = lookup.phrase_rows(index, phrases)
    assert rows.count() == 30 * 5
    joins = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().split("\n")
             if "Join Inner" in line and "term#" in line]
    assert joins and all("path#" in line for line in joins)
    got = {(r.query_id, r.path, r.freq) for r in lookup.phrase_hits(index, phrases).collect()}
    assert got == {(i, f"/{i}", 1) for i in range(30)}


def test_fuzzy_hits_are_dealt_by_document_before_they_multiply(spark, corpus):
    asked = spark.createDataFrame(
        [(i, "fuzzy", "en", w) for i, w in enumerate(("qeuen", "quene", "queen", "kign"))],
        "query_id int, kind string, lang string, text string")
    hits = S.search_hits(build_index(corpus, PLAIN), asked, [S.FUZZY])
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(path" in plan and "hashpartitioning(query_id" not in plan
    found = sorted((r["query_id"], r["path"].split("/")[-1]) for r in hits.collect())
    both = ["king.of.france.txt", "king.txt"]
    assert found == [(i, p) for i in range(4) for p in both]


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_only_kinds_that_share_a_query_are_added_up_together(spark, corpus, asked, monkeypatch):
    index = build_index(corpus, PLAIN)
    calls = []
    either = lookup.either_clause
    monkeypatch.setattr(lookup, "either_clause",
                        lambda *c, apart=False: calls.append(apart) or either(*c, apart=apart))

    def hits(queries):
        return {(r.query_id, r.path): round(r.score, 6)
                for r in S.search_hits(index, queries).collect()}

    accepted = S.validate(asked)[0]
    alone = hits(accepted)
    same = hits(accepted.withColumn("query_id", F.when(
        F.col("kind").isin("term", "fuzzy"), F.lit(None)).otherwise(F.col("query_id"))))
    assert calls == [True, False]
    for path in {p for q, p in alone if q in (1, 4, 6, 8)}:
        assert abs(same[(None, path)] - sum(alone.get((q, path), 0) for q in (1, 4, 6, 8))) < 1e-5
    assert {k: v for k, v in same.items() if k[0] is not None} == {
        k: v for k, v in alone.items() if k[0] not in (1, 4, 6, 8)}
    parts = [spark.range(9).selectExpr("id AS query_id", "string(id) AS path", "1D AS score")
             .repartition(3, "path") for _ in "ab"]
    # documents lie together: their hits add up without another shuffle
    assert len(_exchanges(either(*parts, apart=True))) == len(_exchanges(parts[0])) * 2


def test_statistics_of_rare_terms_alone_are_joined_by_shuffle(spark, corpus):
    index = build_index(corpus.unionByName(corpus.select(
        "path", F.lit(None).cast("string").alias("lang"), "title", "body")), PLAIN)
    want = sorted(index.postings.join(index.term_stats(), lookup.KEY).select(
        *lookup.KEY, "path", "tf", "df", "ttf").collect())
    for limit in (0, 1, 3, 100):
        got = lookup.with_df(index.postings, index.term_stats(), limit)
        assert sorted(got.select(*lookup.KEY, "path", "tf", "df", "ttf").collect()) == want
    # all terms small enough: postings are not shuffled
    rows = spark.createDataFrame([("en", "body", "a", "p")], "lang string, field string, term string, path string")
    stats = spark.createDataFrame([("en", "body", "a", 1, 1)],
                                  "lang string, field string, term string, df long, ttf long")
    assert not _exchanges(lookup.with_df(rows, stats))
