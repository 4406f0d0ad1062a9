import random
from collections import Counter

from pyspark.sql import functions as F

from lexharbor.functions import stem_en
from lexharbor.functions.text import WORDS_JOINED, ancestors_of, kept_length, mark_words, title_of
from lexharbor.operators import postings as P
from lexharbor.operators.analysis import (
    DEFAULT, ENGLISH, PLAIN, STANDARD, Analyzer, Registry, Tables, analyze_with_tables)
from lexharbor.operators.vocabulary import analyze, analyze_queries
from lexharbor.plans.index import build_index
from lexharbor.plans.search import search
from lexharbor.plans.snapshot import Snapshots


def terms(spark, text, analyzer):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    return [(r.pos, r.term) for r in analyze(df, "id", "text", analyzer).orderBy("pos").collect()]


def test_title_keeps_stop_words(spark):
    assert terms(spark, "king of France txt", STANDARD) == [
        (0, "king"), (1, "of"), (2, "france"), (3, "txt")]


def test_english_body_leaves_gaps(spark):
    assert terms(spark, "The king of France met the queen.", ENGLISH) == [
        (1, "king"), (3, "franc"), (4, "met"), (6, "queen")]


def test_possessive_takes_no_place(spark):
    plain = Analyzer(possessive=True)
    assert terms(spark, "The king’s men's hats", plain) == [
        (0, "the"), (1, "king"), (2, "men"), (3, "hats")]
    joined = Analyzer(pattern=WORDS_JOINED, possessive=True)
    assert terms(spark, "king's file.txt 3.14", joined) == [
        (0, "king"), (1, "file.txt"), (2, "3.14")]


def porter(word):
    """The published rules, one word at a time."""
    def shape(w):
        out = ""
        for ch in w:
            out += "v" if ch in "aeiou" or (ch == "y" and out[-1:] == "c") else "c"
        return out

    def hissing(w):
        return shape(w).endswith("cvc") and w[-1] not in "wxy"

    def ending(w, ends):
        return max((e for e in ends if w.endswith(e)), key=len, default=None)

    if len(word) < 3:
        return word
    for end, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(end):
            word = word[:len(word) - len(end)] + new
            break
    if word.endswith("eed"):
        if "vc" in shape(word[:-3]):
            word = word[:-1]
    elif (end := ending(word, ("ed", "ing"))) and "v" in shape(word[:-len(end)]):
        word = word[:-len(end)]
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif shape(word).endswith("cc") and word[-1] == word[-2] and word[-1] not in "lsz":
            word = word[:-1]
        elif shape(word).count("vc") == 1 and hissing(word):
            word += "e"
    if word.endswith("y") and "v" in shape(word[:-1]):
        word = word[:-1] + "i"
    for rules in (dict(stem_en.STEP_2), dict(stem_en.STEP_3)):
        if (end := ending(word, rules)) and "vc" in shape(word[:-len(end)]):
            word = word[:-len(end)] + rules[end]
    if end := ending(word, stem_en.STEP_4):
        stem = word[:-len(end)]
        if shape(stem).count("vc") > 1 and (end != "ion" or stem[-1:] in ("s", "t")):
            word = stem
    if word.endswith("e"):
        m = shape(word[:-1]).count("vc")
        if m > 1 or (m == 1 and not hissing(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and shape(word).count("vc") > 1:
        word = word[:-1]
    return word


def test_stem_cascade_equals_the_rules_word_by_word(spark):
    rng = random.Random(3)
    ends = [a for a, _ in stem_en.STEP_2 + stem_en.STEP_3] + list(stem_en.STEP_4) + [
        "s", "ies", "sses", "ed", "ing", "eed", "y", "e", "ll", ""]
    words = {"".join(rng.choices("aeiouyybcdlstwxzé1", k=rng.randrange(6)))
             + "".join(rng.choices(ends, k=rng.randrange(3))) for _ in range(4000)}
    frame = spark.createDataFrame([(w,) for w in sorted(words)], "term string")
    got = {r.term: r.stem for r in stem_en.stems(frame).collect()}
    assert got == {w: porter(w) for w in words}


def test_stems(spark):
    known = {"running": "run", "cats": "cat", "france": "franc", "queen": "queen",
                       "happy": "happi", "caresses": "caress", "ponies": "poni",
                       "relational": "relat", "vietnamization": "vietnam", "hopping": "hop",
                       "falling": "fall", "filing": "file", "sky": "sky", "rate": "rate",
                       "controll": "control", "roll": "roll", "adoption": "adopt",
                       "agreed": "agre", "plastered": "plaster", "is": "is"}
    frame = spark.createDataFrame([(w,) for w in known], "term string")
    assert {r.term: r.stem for r in stem_en.stems(frame).collect()} == known
    plan = stem_en.stems(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_kept_length(spark):
    def kept(n):
        if n < 40:
            return n
        over, drop = n - 24, max(0, (n - 24).bit_length() - 4)
        return 24 + ((over >> drop) << drop)

    got = spark.range(1, 3000).select(
        "id", kept_length(F.col("id").cast("int")).alias("k")).collect()
    assert all(r.k == kept(r.id) for r in got)


def test_postings_match_a_plain_count(spark):
    docs = spark.createDataFrame([
        ("p1", "en", "a.b", "x y x the z x"), ("p2", "fr", "t", "y y the"), ("p3", "en", "", "")],
        "path string, lang string, title string, body string")
    rows = P.postings(docs, PLAIN).filter("field = 'body'").collect()
    got = {(r.path, r.term): (r.len, r.tf, r.positions) for r in rows}
    assert got == {("p1", "x"): (5, 3, [0, 2, 5]), ("p1", "y"): (5, 1, [1]),
                   ("p1", "z"): (5, 1, [4]), ("p2", "y"): (3, 2, [0, 1]),
                   ("p2", "the"): (3, 1, [2])}
    assert Counter(r.path for r in rows if r.first) == {"p1": 1, "p2": 1}


def test_postings_of_terms_that_fall_together_merge(spark):
    docs = spark.createDataFrame([
        ("p1", "en", "cats", "Cats run, the cat ran: running cats"), ("p2", "pl", "psy", "psy i kot psa"),
        ("p3", "fr", "", "cats cat"), ("p4", "pl", "i", "i i"), ("p5", "en", "", "")],
        "path string, lang string, title string, body string")
    tables = Tables(("pl",), spark.createDataFrame([("pl", "i"), ("pl", "i"), ("fr", "cat")],
                                                   "lang string, term string"),
                    spark.createDataFrame([("pl", "psy", "pies"), ("pl", "psa", "pies"),
                                           ("pl", "psa", "pieso"), ("pl", "i", "x")],
                                          "lang string, term string, stem string"))
    registry = Registry(tables=tables)
    rows = P.postings(docs, registry).collect()
    got = {(r.path, r.field, r.term): (r.len, r.tf, r.positions) for r in rows}
    assert got == {
        ("p1", "title", "cats"): (1, 1, [0]),
        ("p1", "body", "cat"): (6, 3, [0, 3, 6]), ("p1", "body", "run"): (6, 2, [1, 5]),
        ("p1", "body", "ran"): (6, 1, [4]),
        ("p2", "title", "psy"): (1, 1, [0]),
        ("p2", "body", "pies"): (3, 2, [0, 3]), ("p2", "body", "kot"): (3, 1, [2]),
        ("p3", "body", "cats"): (2, 1, [0]), ("p3", "body", "cat"): (2, 1, [1]),
        ("p4", "title", "i"): (1, 1, [0])}
    assert Counter((r.path, r.field) for r in rows if r.first) == Counter(
        {(p, f): 1 for p, f, _ in got})
    lengths = {(r.path, r.field): r.len for r in P.doc_lengths(docs, registry).collect()}
    assert lengths == {(p, f): v[0] for (p, f, _), v in got.items()}


def test_tables_reach_index_search_and_snippets(spark, tmp_path):
    docs = spark.createDataFrame([
        ("/a", "pl", "jeden", "Dwa psy i kot."), ("/b", "pl", "dwa", "I nie ma psa, i nie ma"),
        ("/c", "en", "psy", "psy running")], "path string, lang string, title string, body string")
    tables = Tables(("pl",), spark.createDataFrame([("pl", "i")], "lang string, term string"),
                    spark.createDataFrame([("pl", "psy", "pies"), ("pl", "psa", "pies")],
                                          "lang string, term string, stem string"))
    registry = Registry(tables=tables)
    asked = spark.createDataFrame([
        (1, "term", "pl", "Psa"), (2, "phrase", "pl", "dwa psa"), (3, "term", "pl", "i"),
        (4, "term", "en", "runs"), (5, "fuzzy", "pl", "piez")],
        "query_id int, kind string, lang string, text string")
    terms = {(r.query_id, r.field): r.terms for r in analyze_queries(asked, registry).collect()}
    assert terms[1, "body"] == ["pies"] and terms[1, "title"] == ["psa"]
    assert terms[3, "body"] == [] and terms[4, "body"] == ["run"] and len(terms) == 10
    stored = Snapshots(spark, str(tmp_path / "index"), registry, buckets=2)
    stored.publish(docs)
    for index in (build_index(docs, registry), stored.open()):
        found = search(index, asked, 10, details=True)
        hits = {(r.query_id, r.path) for r in found.hits.collect()}
        assert hits == {(1, "/a"), (1, "/b"), (2, "/a"), (4, "/c"), (5, "/a"), (5, "/b")}
        texts = {(r.query_id, r.path): r.text for r in found.snippets.collect()}
        assert texts[1, "/b"] == "I nie ma <b>psa</b>, i nie ma"
        assert texts[2, "/a"] == "<b>Dwa</b> <b>psy</b> i kot."
        assert texts[4, "/c"] == "psy <b>running</b>"


def test_totals_agree(corpus):
    rows = P.postings(corpus, DEFAULT)
    total = rows.agg(F.sum("tf")).first()[0]
    assert total == P.doc_lengths(corpus, DEFAULT).agg(F.sum("len")).first()[0]
    assert total == P.term_stats(rows).agg(F.sum("ttf")).first()[0]
    assert total == P.lengths_of(rows).agg(F.sum("len")).first()[0]


def test_table_driven_analysis(spark):
    tokens = spark.createDataFrame([("pl", "p", 0, "psy"), ("pl", "p", 1, "i"), ("pl", "p", 2, "kot")],
                                   "lang string, path string, pos int, term string")
    stop = spark.createDataFrame([("pl", "i")], "lang string, term string")
    stems = spark.createDataFrame([("pl", "psy", "pies")], "lang string, term string, stem string")
    got = analyze_with_tables(tokens, stop, stems).orderBy("pos").collect()
    assert [(r.pos, r.term) for r in got] == [(0, "pies"), (2, "kot")]


def test_small_expressions(spark):
    row = spark.range(1).select(
        title_of(F.lit("/c/king.of.france.txt")).alias("title"),
        ancestors_of(F.lit("/c/a/x")).alias("up"),
        mark_words(F.lit("The King, the end"), F.array(F.lit("the"))).alias("marked")).first()
    assert row.title == "king of france txt"
    assert row.up == ["/", "/c", "/c/a", "/c/a/x"]
    assert row.marked == "<b>The</b> King, <b>the</b> end"


def test_stems_are_settled_where_the_documents_lie(spark):
    """Documents dealt by a column stay where they are, however their terms fall together."""
    docs = spark.createDataFrame(
        [(f"/{i}", ("en", "fr", None)[i % 3], f"kings {i}", f"The kings of a king {i} ran, run, running")
         for i in range(40)], "path string, lang string, title string, body string")
    dealt = docs.withColumn("unit", (F.hash("path") % 4 + 4).cast("int")).repartitionById(8, "unit")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = P.postings(dealt, DEFAULT, "unit")
        plan = rows._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in plan.split("\n") if " Exchange " in line]
        assert moved and all("shufflepartitionidpassthrough" in line for line in moved)
        got = {(r.path, r.field, r.term): (r.len, r.tf, r.positions) for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got["/0", "body", "king"] == (6, 2, [1, 4]) and got["/0", "body", "run"] == (6, 2, [7, 8])
    assert got["/1", "body", "kings"] == (9, 1, [1]) and got["/0", "title", "kings"][1] == 1
    assert ("/2", "title", "kings") in got and not [k for k in got if k[:2] == ("/2", "body")]
    plain = {(r.path, r.field, r.term): (r.len, r.tf, r.positions)
             for r in P.postings(docs, DEFAULT).collect()}
    assert got == plain


def test_a_task_counts_the_grams_of_few_texts_at_once(spark, monkeypatch):
    import pyarrow as pa

    from lexharbor.operators import language

    texts = [" abcab ", None, " a ", "", " b" * 40, " \U0001f600xy "] * 3
    whole = language._counted(pa.array(texts, pa.string())).to_pylist()
    seen = []
    counted = language._counted
    monkeypatch.setattr(language, "_counted", lambda p: seen.append(len(p)) or counted(p))
    monkeypatch.setattr(language, "PIECE_CHARS", 16)
    pieces = language._pieces(pa.array(texts, pa.string()))
    assert [row for _, p in pieces for row in language._counted(p).to_pylist()] == whole
    assert sum(seen) == len(texts) and len(seen) > 3 and max(seen) < 9
    rows = spark.createDataFrame([(i % 4 or None, t) for i, t in enumerate(texts)],
                                 "k long, t string")
    got = language.gram_rows(rows, "k", "t").groupBy("k").count().collect()
    assert {r.k for r in got} == {None, 1, 2, 3}
