import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexharbor.operators import changes, language, maintain
from lexharbor.operators import postings as P
from lexharbor.operators.analysis import DEFAULT, PLAIN
from lexharbor.operators.prefixes import RAW, SEGMENT
from lexharbor.plans import snapshot
from lexharbor.plans.index import build_index
from lexharbor.plans.search import search
from lexharbor.plans.snapshot import Snapshots, State
from lexharbor.session import materialize, scratch_path
from lexharbor.sources import files, roots as root_list
from lexharbor.streaming.changes import EVENTS, change_stream, run_changes
from lexharbor.verify import inputs


def paths(df):
    return sorted(r.path for r in df.select("path").collect())


def events_of(spark, rows):
    return spark.createDataFrame([(s, k, p, "en", "t", f"b{s}") for s, k, p in rows], EVENTS)


HAND = [(1, "CREATE", "/c/a/x.txt"), (2, "CREATE", "/c/ab/y.txt"), (3, "DELETE", "/c/a"),
        (4, "CREATE", "/c/a/x.txt"), (5, "OVERFLOW", None)]


def test_fold_by_hand(spark):
    events = events_of(spark, HAND)
    assert paths(changes.fold_changes(events, RAW)) == ["/c/a/x.txt"]
    assert paths(changes.fold_changes(events, SEGMENT)) == ["/c/a/x.txt", "/c/ab/y.txt"]


@pytest.mark.parametrize("mode", [RAW, SEGMENT])
def test_fold_equals_replay(spark, mode):
    rng = random.Random(5)
    rows, live = [], {}
    for seq in range(400):
        folder = f"/c/u{rng.randint(1, 15)}"
        if rng.random() < 0.3:
            rows.append((seq, "DELETE", folder))
            under = (lambda p: p.startswith(folder)) if mode == RAW else (
                lambda p: p == folder or p.startswith(folder + "/"))
            live = {p: s for p, s in live.items() if not under(p)}
        else:
            kind, path = rng.choice(["CREATE", "MODIFY"]), f"{folder}/{rng.randint(0, 14)}"
            rows.append((seq, kind, path))
            if kind == "MODIFY" and mode == RAW:   # a removal by prefix, then an addition
                live = {p: s for p, s in live.items() if not p.startswith(path)}
            live[path] = seq
    got = changes.fold_changes(events_of(spark, rows), mode).collect()
    assert {r.path: r.seq for r in got} == live


def test_modify_takes_longer_names_in_raw_mode(spark):
    events = events_of(spark, [(1, "CREATE", "/c/a"), (2, "CREATE", "/c/ab"), (3, "MODIFY", "/c/a")])
    assert paths(changes.fold_changes(events, RAW)) == ["/c/a"]
    assert paths(changes.fold_changes(events, SEGMENT)) == ["/c/a", "/c/ab"]


def test_root_folder_matches_alike_in_both_forms(spark):
    docs = spark.createDataFrame([("/c/a",), ("/d",), ("e/f",), ("/",)], "path string")
    for root, left in (("/", ["e/f"]), ("/c", ["/", "/d", "e/f"]), ("/c/", ["/", "/d", "e/f"])):
        table = spark.createDataFrame([(root,)], "prefix string")
        assert paths(maintain.remove_under(docs, root, SEGMENT)) == left
        assert paths(maintain.remove_prefixes(docs, table, SEGMENT)) == left


def test_batch_that_changes_between_evaluations_loses_no_document(spark):
    columns = "path string, lang string, title string, body string"
    docs = spark.createDataFrame([(f"/c/{i}", "en", "t", f"b{i}") for i in range(40)], columns)
    store = Snapshots(spark, scratch_path(spark, "moving"), DEFAULT, buckets=8)
    store.publish(docs)
    for k in range(3):
        moving = docs.limit(1).withColumn("path", F.concat(F.lit(f"/new{k}/"), F.uuid()))
        store.upsert(moving)
    assert store.open().docs.count() == 43


def test_a_path_is_stored_once(spark):
    columns = "path string, lang string, title string, body string"
    twice = spark.createDataFrame([("/c/1", "en", "t", "old words"), ("/c/1", "en", "t", "words"),
                                   ("/c/2", "en", "t", "words")], columns)
    store = Snapshots(spark, scratch_path(spark, "twice"), DEFAULT, buckets=4)
    index = store.publish(twice)
    assert paths(index.docs) == ["/c/1", "/c/2"]
    df = {r.term: r.df for r in index.term_stats().filter("field = 'body'").collect()}
    assert df == {"word": 2}
    roots = spark.createDataFrame([(1, "/c"), (2, "/c/1")], "seq long, path string")
    assert paths(store.reindex(twice.union(twice), roots).docs) == ["/c/1", "/c/2"]


def test_listing_diff(spark):
    old = spark.createDataFrame([("p1", 1, 10), ("p2", 1, 20), ("p3", 1, 30)],
                                "path string, mtime int, length long")
    new = spark.createDataFrame([("p1", 1, 10), ("p2", 2, 20), ("p4", 1, 5)],
                                "path string, mtime int, length long")
    got = changes.snapshot_diff(old, new, ["mtime", "length"]).collect()
    assert {r.path: r.kind for r in got} == {"p2": "MODIFY", "p3": "DELETE", "p4": "CREATE"}


def test_removal_modes(spark, corpus):
    assert paths(maintain.remove_under(corpus, "/c/a")) == ["/c/b/empty.txt"]
    assert paths(maintain.remove_under(corpus, "/c/a", SEGMENT)) == [
        "/c/ab/king.of.france.txt", "/c/b/empty.txt"]
    table = spark.createDataFrame([("/c/a/",), ("/nowhere",)], "prefix string")
    assert paths(maintain.remove_prefixes(corpus, table, SEGMENT)) == [
        "/c/ab/king.of.france.txt", "/c/b/empty.txt"]
    with pytest.raises(ValueError):
        maintain.remove_prefixes(corpus, table, "other")


def test_roots(spark, corpus):
    roots = spark.createDataFrame([(1, "/c/a"), (2, "/c/b")], "seq long, path string")
    more = spark.createDataFrame([(3, "/c/a"), (4, "/d")], "seq long, path string")
    every = maintain.register_roots(roots, more)
    assert [(r.seq, r.path) for r in root_list.listed(every).collect()] == [
        (1, "/c/a"), (2, "/c/b"), (4, "/d")]
    left, docs = maintain.unregister_root(roots, corpus, "/c/a", SEGMENT)
    assert paths(left) == ["/c/b"] and len(paths(docs)) == 2
    same, all_docs = maintain.unregister_root(roots, corpus, "/c", SEGMENT)
    assert paths(same) == ["/c/a", "/c/b"] and len(paths(all_docs)) == 3


def test_snapshots(spark, corpus, asked):
    store = Snapshots(spark, scratch_path(spark, "t"), DEFAULT, buckets=4, splits=2)
    assert not store.exists() and store.open().docs.count() == 0
    first = store.publish(corpus)
    batch = corpus.filter("path = '/c/b/empty.txt'").withColumn("body", F.lit("A new king"))
    again = store.upsert(batch)
    assert first.docs.filter("body = ''").count() == 1  # an open index does not change
    term = asked.filter("query_id = 1")
    assert search(again, term, kinds=["term"]).hits.count() == 3
    twice = store.upsert(batch)
    assert twice.term_stats().agg(F.sum("ttf")).first() == again.term_stats().agg(
        F.sum("ttf")).first()
    store.remove("/c/a", SEGMENT)
    assert paths(store.open().docs) == ["/c/ab/king.of.france.txt", "/c/b/empty.txt"]
    roots = spark.createDataFrame([(1, "/c/ab")], "seq long, path string")
    scan = corpus.filter("path like '/c/ab/%'").withColumn("body", F.lit("fresh"))
    got = store.reindex(scan, roots, SEGMENT)
    assert {r.path: r.body for r in got.docs.collect()} == {
        "/c/ab/king.of.france.txt": "fresh", "/c/b/empty.txt": "A new king"}
    level = store.reconcile(corpus)
    assert sorted(map(str, level.docs.collect())) == sorted(map(str, corpus.collect()))
    assert level.term_stats().filter("term = 'fresh'").count() == 0
    store.purge()
    assert store.open().docs.count() == 0 and store.exists()


def test_stream_equals_batch(spark):
    rows = [(1, "CREATE", "/c/a/x"), (2, "CREATE", "/c/b/y"), (3, "DELETE", "/c/a"),
            (4, "CREATE", "/c/a/z"), (5, "MODIFY", "/c/b/y"), (6, "OVERFLOW", None),
            (7, "CREATE", "/out/q")]
    folder = scratch_path(spark, "events")
    for part in (rows[:2], rows[2:4], rows[4:]):
        events_of(spark, part).coalesce(1).write.mode("append").parquet(folder)
    roots = spark.createDataFrame([("/c",)], "path string")
    store = Snapshots(spark, scratch_path(spark, "s"), DEFAULT, buckets=4)
    offsets = scratch_path(spark, "o")
    for _ in range(2):  # the second run finds nothing new
        run_changes(change_stream(spark, folder, files_per_batch=1), store, offsets,
                    SEGMENT).wait()
    want = changes.fold_changes(events_of(spark, rows), SEGMENT)
    got = store.open().docs
    assert {(r.path, r.body) for r in got.collect()} == {(r.path, r.body) for r in want.collect()}
    inside = changes.events_in_roots(events_of(spark, rows), roots, SEGMENT)
    assert sorted(r.seq for r in inside.collect()) == [1, 2, 3, 4, 5]
    before = store.state().v
    store.apply(events_of(spark, rows), SEGMENT, batch_id=0)  # a replayed batch
    assert store.state().v == before


def test_overflow_makes_the_batch_compare_with_a_listing(spark):
    folder = scratch_path(spark, "events")
    for part in ([(1, "CREATE", "/c/a/x"), (2, "CREATE", "/c/b/y")],
                 [(3, "OVERFLOW", None), (4, "CREATE", "/c/gone")], [(5, "MODIFY", "/c/a/x")]):
        events_of(spark, part).coalesce(1).write.mode("append").parquet(folder)
    now = spark.createDataFrame([("/c/a/x", "en", "x", "b1"), ("/c/new", "en", "new", "lost and found")],
                                "path string, lang string, title string, body string")
    store = Snapshots(spark, scratch_path(spark, "s"), DEFAULT, buckets=4)
    calls = []

    def listing():
        calls.append(1)
        return now

    run_changes(change_stream(spark, folder, files_per_batch=1), store, scratch_path(spark, "o"),
                SEGMENT, listing=listing).wait()
    got = {r.path: r.body for r in store.open().docs.collect()}
    assert got.keys() == {"/c/a/x", "/c/new"} and got["/c/new"] == "lost and found"
    assert calls == [1] and got["/c/a/x"] != "b1"  # the last batch came after the listing
    before = store.state().v
    store.apply(events_of(spark, [(3, "OVERFLOW", None)]), SEGMENT, batch_id=1, scan=listing)
    assert store.state().v == before and calls == [1]  # a replay asks for no listing


def test_a_watch_takes_up_new_roots_and_ends_with_the_last(spark):
    folder = scratch_path(spark, "events")
    events_of(spark, [(1, "CREATE", "/a/x"), (2, "CREATE", "/b/y")]).coalesce(1).write.parquet(folder)
    store = Snapshots(spark, scratch_path(spark, "s"), DEFAULT, buckets=4)
    nothing = store.open().docs
    store.register(spark.createDataFrame([("/a",)], "path string"), nothing)
    watch = run_changes(change_stream(spark, folder, files_per_batch=1), store,
                        scratch_path(spark, "o"), SEGMENT, watched=True,
                        processingTime="200 milliseconds")

    def until(seen):
        for _ in range(120):
            if seen():
                return True
            watch.wait(0.5)
        return False

    try:
        assert until(lambda: paths(store.open().docs) == ["/a/x"])
        store.register(spark.createDataFrame([("/b",), ("/a",)], "path string"), nothing)
        assert [(r.seq, r.path) for r in root_list.listed(store.roots()).collect()] == [
            (1, "/a"), (3, "/b")]
        events_of(spark, [(3, "CREATE", "/b/z"), (4, "DELETE", "/b"), (5, "CREATE", "/b/late")]
                  ).coalesce(1).write.mode("append").parquet(folder)
        assert until(lambda: paths(store.roots()) == ["/a"])
        assert paths(store.open().docs) == ["/a/x"]
        events_of(spark, [(6, "DELETE", "/")]).coalesce(1).write.mode("append").parquet(folder)
        assert watch.wait(60) and not watch.query.isActive
        assert store.roots().isEmpty() and store.open().docs.isEmpty()
    finally:
        watch.stop()


def test_roots_are_versioned_with_the_documents(spark, corpus):
    store = Snapshots(spark, scratch_path(spark, "r"), DEFAULT, buckets=4)
    given = spark.createDataFrame([(9, "/c/b"), (3, "/c/a")], "seq long, path string")
    store.publish(corpus, given)
    old = store.state()
    again = corpus.filter("path like '/c/ab/%'").withColumn("body", F.lit("new"))
    store.register(spark.createDataFrame([("/c/ab",), ("/c/a",)], "path string"), again)
    assert [r.path for r in root_list.listed(store.roots()).collect()] == ["/c/a", "/c/b", "/c/ab"]
    assert store.open().docs.filter("body = 'new'").count() == 1
    store.unregister(spark.createDataFrame([("/c",), ("/nowhere",)], "path string"))
    assert store.state().v == old.v + 1  # neither is listed
    store.unregister(spark.createDataFrame([("/c/a",)], "path string"), SEGMENT)
    assert paths(store.roots()) == ["/c/ab", "/c/b"] and len(paths(store.open().docs)) == 2
    store.reindex(corpus.filter("path like '/c/b/%'"), mode=SEGMENT)  # the stored roots
    assert paths(store.open().docs) == ["/c/b/empty.txt"]
    assert len(paths(store._index(old).docs)) == 3 and paths(store._roots(old)) == ["/c/a", "/c/b"]
    store.purge()
    assert store.roots().isEmpty() and store.open().docs.isEmpty()
    store.publish(corpus)
    assert store.roots().isEmpty()


def test_files_that_cannot_be_read_become_rows(spark, tmp_path):
    tree = tmp_path / "tree"
    spark.createDataFrame([("some words",)], "value string").coalesce(1).write.text(str(tree / "a"))
    (tree / "good.txt").write_text("fine")
    (tree / "x.pdf").write_bytes(b"%PDF-1.4")
    damaged = next((tree / "a").glob("part-*.txt"))
    damaged.write_text("other words, so that the stored checksum no longer holds")
    read = {r.path: (r.body, r.error) for r in files.read_files(spark, str(tree)).collect()}
    assert read[str(damaged)] == (None, "the file could not be read")
    assert read[str(tree / "good.txt")] == ("fine", None)
    assert read[str(tree / "x.pdf")] == (None, "no extractor for application/pdf")


def test_one_pass_serves_all_extractors(spark, tmp_path):
    for name in ("a.txt", "b.pdf", "c.rtf", "d.odt"):
        (tmp_path / name).write_text(name)
    rows = files.scan(spark, str(tmp_path))
    got = files.extract(rows, {"pdf": lambda p, c: "pdf!", "rtf": lambda p, c: "rtf!"})
    assert {(r.path.rsplit("/", 1)[-1], r.body, r.error) for r in got.collect()} == {
        ("a.txt", "a.txt", None), ("b.pdf", "pdf!", None), ("c.rtf", "rtf!", None),
        ("d.odt", None, "no extractor for application/vnd.oasis.opendocument.text")}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan binaryFile") == 1


def test_media_types(spark):
    rows = [("/c/a.docx", "", True), ("/c/a.xlsx", "", True), ("/c/a.odt", "", True),
            ("/c/a.ods", "", False), ("/c/a.pdf", "", True), ("/c/a.rtf", "", True),
            ("/c/a.txt", "hi", True), ("/c/a.html", "hi", False), ("/c/b", "%PDF-1.4", True),
            ("/c/n", "<!DOCTYPE html>", False), ("/c/plain", "hi", True), ("/c/bin", "a\u0001", False)]
    df = spark.createDataFrame(rows, "path string, head string, keep boolean")
    mime = files.media_type(F.col("path"), F.col("head"))
    bad = df.filter(files.is_indexed(mime) != F.col("keep")).collect()
    assert bad == []


def test_file_tree(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("Hello world", "utf-8")
    (tmp_path / "sub" / "b.c.txt").write_bytes(b"\xef\xbb\xbfbad \xff byte")
    (tmp_path / "x.pdf").write_bytes(b"%PDF-1.4 text")
    (tmp_path / "y.rtf").write_bytes(b"{\\rtf1 text}")
    (tmp_path / "z.html").write_text("<html>", "utf-8")
    rows = files.scan(spark, str(tmp_path))

    def broken(path, content):
        raise ValueError("no")

    got = files.extract(rows, {"pdf": lambda p, c: c.decode()[9:], "rtf": broken})
    docs, errors = files.documents(got)
    assert {(r.path.rsplit("/", 1)[-1], r.title, r.body) for r in docs.collect()} == {
        ("a.txt", "a txt", "Hello world"), ("b.c.txt", "b c txt", "bad � byte"),
        ("x.pdf", "x pdf", "text")}
    assert [r.error for r in errors.collect()] == ["ValueError: no"]
    assert files.scan(spark, str(tmp_path / "a.txt")).count() == 1
    with pytest.raises(ValueError):
        files.scan(spark, str(tmp_path / "none"))


def test_language(spark):
    rows = [("en", "the king and the queen went there with them then"),
            ("pl", "król i królowa poszli tam razem żeby zobaczyć się")]
    profile = language.train(spark.createDataFrame(rows * 20, "lang string, text string"))
    docs = spark.createDataFrame([("1", "królowa poszli razem"), ("2", "the queen went"), ("3", "12")],
                                 "path string, body string")
    got = language.detect(docs, profile).select(
        "path", "detected", "certain",
        language.route(F.col("certain"), F.col("detected")).alias("lang")).collect()
    assert {(r.path, r.detected, r.certain, r.lang) for r in got} == {
        ("1", "pl", True, "pl"), ("2", "en", True, "en"), ("3", None, False, "en")}


def test_reindex_files_checks_all_roots_first(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.txt").write_text("some words here")
    (tmp_path / "a" / "two.pdf").write_bytes(b"%PDF-1.4")
    store = Snapshots(spark, scratch_path(spark, "files"), DEFAULT, buckets=2)
    good = spark.createDataFrame([(1, str(tmp_path / "a"))], "seq long, path string")
    index, errors = store.reindex_files(good)
    assert paths(index.docs) == [str(tmp_path / "a" / "one.txt")]
    assert [r.path for r in errors.collect()] == [str(tmp_path / "a" / "two.pdf")]
    bad = good.union(spark.createDataFrame([(2, str(tmp_path / "none"))], good.schema))
    with pytest.raises(ValueError):
        store.reindex_files(bad)
    assert len(paths(store.open().docs)) == 1


def test_a_tree_is_written_by_shelves_and_read_whole(spark, tmp_path):
    rows = [(f"s/{i % 3}", None if i % 5 == 0 else "en", i, f"text {i}") for i in range(200)]
    rows += [("s/0", "en", 501, None), ("s/0", "en", 502, "a"), ("s/0", "en", 502, "a")]
    docs = spark.createDataFrame(rows, "source string, lang string, doc_id long, text string")
    inputs.write_tree(docs, ["source", "lang", "doc_id"], "text", "|", str(tmp_path / "t"))
    shelves = list((tmp_path / "t").iterdir())
    assert 33 <= len(shelves) <= inputs.LEAST_SHELVES  # Spark lists over 32 folders as a job
    assert not list((tmp_path / "t").rglob("*.crc"))
    got = {tuple(r.path.split("/")[-4:-1]): r.body
           for r in files.read_files(spark, str(tmp_path / "t")).collect()}
    want = {("source=s%2F" + s[2:], f"lang={lang or '__HIVE_DEFAULT_PARTITION__'}", f"doc_id={i}"):
            f"{t or ''}|" for s, lang, i, t in rows}
    assert got == want | {("source=s%2F0", "lang=en", "doc_id=502"): "a|a|"}


def test_tasks_that_write_an_index_grow_with_the_text(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path), buckets=8)
    for size in (1 << 30, 6 << 30):
        state = store._dealt(State(), size)
        assert size / (state.buckets * state.splits) <= 16 << 20
    assert store._dealt(State(), 1000).splits == 1


def test_different_grams_of_a_text_are_one_row_each(spark):
    texts = ["Ab-ab  AB!", None, "", "42", "é𝒜ż" * 3, "to be or not to be " * 500]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select(
        "k", language.counted_grams(language.letters_of(F.col("t"))).alias("g"))
    for r in rows.collect():
        letters = " " + " ".join(re.findall(r"[^\W\d_]+", (texts[r.k] or "").lower())) + " "
        runs = Counter(letters[i:i + 3] for i in range(len(letters) - 2)) if texts[r.k] else {}
        assert {g.gram: g.n for g in r.g or ()} == runs and len(r.g or ()) == len(runs)
        assert all(g.n_grams == sum(runs.values()) for g in r.g or ())


def test_detection_cuts_the_labelled_texts_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(text):
        read.add(1)
        return text

    rows = spark.createDataFrame([("en", "the king"), ("fr", "le roi"), ("de", "der herr")],
                                 "lang string, text string")
    profile = language.train(rows.select("lang", noted("text").alias("text")))
    docs = spark.createDataFrame([("/1", "the king"), ("/2", None)], "path string, body string")
    got = {r.path: r.detected for r in language.detect(docs, profile).collect()}
    assert got == {"/1": "en", "/2": None} and read.value == 3


def test_folders_are_written_side_by_side_each_by_term(spark, tmp_path):
    """More folders than a task opens at once; the session's own setting is back afterwards."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    docs = spark.createDataFrame([(f"/{i}", f"l{i % 12}", f"t{i}", f"z{i % 7} b c{i} a a") for i in range(90)],
                                 "path string, lang string, title string, body string")
    spark.conf.set(name, "3")
    try:
        for registry in (PLAIN, DEFAULT):
            root = f"{tmp_path}/{len(registry.bound)}{registry.resolves()}"
            index = Snapshots(spark, root, registry, buckets=1, splits=1, slots=3).publish(docs)
            assert spark.conf.get(name) == "3"
            columns = ["path", "lang", "field", "len", "term", "tf", "first", "positions"]
            want = build_index(docs, registry).postings.select(columns)
            got = index.postings.select(columns)
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.unset(name)
    few = Snapshots(spark, f"{tmp_path}/few", PLAIN, buckets=2, splits=2, slots=2).publish(
        docs.withColumn("lang", F.lit("fr"))).postings
    terms = {}
    for r in few.select(F.input_file_name().alias("file"), "term").collect():
        terms.setdefault(r.file, []).append(r.term)
    assert len(terms) > 8 and all(t == sorted(t) for t in terms.values())


def _postings_of(index):
    return sorted((r.lang or "", r.field, r.term, r.path or "", r.len, r.tf, r.first, tuple(r.positions))
                  for r in index.postings.collect())


def _stats_of(index):
    return sorted((r.lang or "", r.field, r.term, r.df, r.ttf) for r in index.term_stats().collect())


def test_an_update_carries_the_postings_of_what_stays(spark, corpus, tmp_path, monkeypatch):
    base = corpus.unionByName(spark.createDataFrame(
        [("/c/d/x.txt", None, "x txt", "Kings running and running"), (None, "en", "none", "no path")],
        corpus.schema))
    batch = spark.createDataFrame([("/c/a/king.txt", "en", "king txt", "A new king stopped"),
                                   ("/new", "de", "new", "neu")], corpus.schema)
    cut = []
    plain = P.postings
    monkeypatch.setattr(P, "postings", lambda docs, *a, **k: cut.append(
        {r.path for r in docs.select("path").collect()}) or plain(docs, *a, **k))
    for limit, registry in ((10, DEFAULT), (0, PLAIN)):
        monkeypatch.setattr(snapshot, "CARRIED_ROWS", limit)
        store = Snapshots(spark, str(tmp_path / f"i{limit}{registry is PLAIN}"), registry, buckets=2)
        store.publish(base)
        cut.clear()
        for gone, fresh in ((None, batch), ("/c/ab", None)):
            index = store.upsert(fresh) if gone is None else store.remove(gone, SEGMENT)
            docs = materialize(index.docs, "test")
            other = Snapshots(spark, str(tmp_path / f"o{len(cut)}{limit}{registry is PLAIN}{gone}".replace("/", "_")),
                              registry, buckets=2).publish(docs)
            if gone is None and limit:
                assert cut[0] == {"/c/a/king.txt", "/new"}
            if gone and limit:
                assert len(cut) == 3  # two publications to compare with, one update
            assert _postings_of(index) == _postings_of(other) and _stats_of(index) == _stats_of(other)


def test_rare_terms_are_stemmed_in_their_rows(spark, corpus, monkeypatch):
    docs = corpus.unionByName(spark.createDataFrame([
        ("/c/d/x.txt", "en", "x txt", "Kings running and runs, relational conditionally kings"),
        ("/c/d/y.txt", "de", "y txt", "kings laufen")], corpus.schema))
    want = sorted(P.postings(docs, DEFAULT).collect())
    for limit in (0, 3):
        monkeypatch.setattr(P, "BROADCAST_ROWS", limit)
        got = P.postings(docs, DEFAULT)
        assert sorted(got.collect()) == want
        assert not P.shuffles(P.known_terms(docs, DEFAULT), DEFAULT)
