"""The registered queries, one per operator, each over the whole of its tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexharbor.functions.text import WORDS_JOINED, kept_length, mark_words
from lexharbor.operators import changes, language, lookup, maintain, ranking, snippets
from lexharbor.operators import postings as P
from lexharbor.operators.analysis import (
    DEFAULT, ENGLISH, ENGLISH_STOP, Analyzer, PLAIN, STANDARD, STOP_EN, Registry, Tables,
    analyze_with_tables, explode_tokens)
from lexharbor.operators.prefixes import RAW, SEGMENT
from lexharbor.operators.suggest import suggest_terms
from lexharbor.operators.vocabulary import analyze, analyze_queries
from lexharbor.plans import search as S
from lexharbor.plans.snapshot import Snapshots
from lexharbor.session import broadcast_within, materialize, scratch_path
from lexharbor.sources import files, roots as root_list
from lexharbor.streaming.changes import run_changes
from lexharbor.verify import inputs as I

Spark, Frame = SparkSession, DataFrame

# one extension per document, in turn, so that every media type occurs
EXTENSIONS = ("txt", "docx", "xlsx", "odt", "ods", "pdf", "rtf", "html")
TOP = 10


def _digest(name: str = "body"):
    return F.md5(name).alias("digest")


def _score():
    return F.round("score", 4).alias("score")


# -- sources -------------------------------------------------------------------

def scan_docs(spark: Spark, sf: str) -> Frame:
    return I.docs(spark, sf).select("path", "lang", "title",
                                    F.length("body").cast("long").alias("n_chars"), _digest())


def scan_tree(spark: Spark, sf: str) -> Frame:
    """Every document written as a file of its own, the tree listed, read and taken apart again."""
    root, end = scratch_path(spark, "tree"), "\x1e"
    folders = ["source", "lang", "doc_id"]
    I.write_tree(I.table(spark, sf, "documents"), folders, "text", end, root)

    def named(folder: str):
        return F.regexp_extract("path", f"/{folder}=([^/]*)/", 1)

    body = F.regexp_replace("body", f"{end}$", "")
    return files.read_files(spark, root).select(
        named("source").alias("source"), named("lang").alias("lang"),
        named("doc_id").cast("long").alias("doc_id"), F.md5(body).alias("digest"), "error")


def _typed(spark: Spark, sf: str) -> Frame:
    chosen = F.array(*[F.lit(e) for e in EXTENSIONS])[
        (F.col("doc_id") % len(EXTENSIONS)).cast("int")]
    named = I.docs_with_id(spark, sf).select(
        F.concat(F.regexp_replace("path", "txt$", ""), chosen).alias("path"),
        F.col("body").alias("head"))
    pages = I.table(spark, sf, "pages").select(
        F.regexp_replace("url", "[?#].*$", "").alias("path"), F.col("html").alias("head"))
    return named.unionByName(pages).select(
        "path", files.media_type(F.col("path"), F.col("head")).alias("mime"))


def media_type_counts(spark: Spark, sf: str) -> Frame:
    return _typed(spark, sf).groupBy("mime").agg(F.count(F.lit(1)).alias("n"))


def media_type_filter(spark: Spark, sf: str) -> Frame:
    return _typed(spark, sf).filter(files.is_indexed(F.col("mime")))


def extract_text(spark: Spark, sf: str) -> Frame:
    raw = I.docs(spark, sf).select("path", F.encode("body", "UTF-8").alias("content"))
    return files.extract(raw).select("path", F.length("body").cast("long").alias("n_chars"), _digest())


def extractor_hook(spark: Spark, sf: str) -> Frame:
    def flat(path: str, content: bytes) -> str:
        return content.decode("utf-8").replace("\n", " ")

    raw = I.docs(spark, sf).select("path", F.encode("body", "UTF-8").alias("content"))
    return files.extract_with(raw, flat).select(
        "path", F.length("body").cast("long").alias("n_chars"), _digest(), "error")


def list_roots(spark: Spark, sf: str) -> Frame:
    return root_list.listed(I.roots(spark, sf))


# -- analysis ------------------------------------------------------------------

def title_terms(spark: Spark, sf: str) -> Frame:
    return analyze(I.docs(spark, sf), "path", "title", STANDARD)


def tokenize(spark: Spark, sf: str) -> Frame:
    return analyze(I.docs(spark, sf), "path", "body", STANDARD)


def tokenize_joined(spark: Spark, sf: str) -> Frame:
    """Words that keep an inner apostrophe, dot or colon between letters, and the signs inside
    numbers."""
    return analyze(I.docs(spark, sf), "path", "body", Analyzer(pattern=WORDS_JOINED))


def analyze_en_stop(spark: Spark, sf: str) -> Frame:
    return analyze(I.docs(spark, sf).filter("lang = 'en'"), "path", "body", ENGLISH_STOP)


def analyze_en_stem(spark: Spark, sf: str) -> Frame:
    return analyze(I.docs(spark, sf).filter("lang = 'en'"), "path", "body", ENGLISH)


def analyze_lang_tables(spark: Spark, sf: str) -> Frame:
    docs = I.docs(spark, sf).filter("lang <> 'en'")
    tokens = explode_tokens(docs.select("path", "lang", STANDARD.tokens(F.col("body")).alias(
        "tokens")), "path", "lang")
    tables = I.language_tables(spark, sf)
    return analyze_with_tables(tokens, tables.stopwords, tables.stems).select(
        "lang", "path", "pos", "term")


def _tabled(spark: Spark, sf: str) -> Registry:
    return Registry(bound=PLAIN.bound, tables=I.language_tables(spark, sf))


def _detected(spark: Spark, sf: str) -> Frame:
    docs = I.docs(spark, sf)
    return language.detect(docs, language.train(docs.withColumnRenamed("body", "text")))


def lang_detect(spark: Spark, sf: str) -> Frame:
    return _detected(spark, sf).withColumn("n_grams", F.col("n_grams").cast("long"))


def lang_route(spark: Spark, sf: str) -> Frame:
    return _detected(spark, sf).select("path", language.route(
        F.col("certain"), F.col("detected"), "fr", "en").alias("lang"))


def _whole_texts(spark: Spark, sf: str) -> Frame:
    return I.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), F.lit("phrase").alias("kind"),
        F.lit("en").alias("lang"), "text")


def analyze_queries_(spark: Spark, sf: str) -> Frame:
    return analyze_queries(_whole_texts(spark, sf), PLAIN).select(
        "query_id", "field", F.size("terms").cast("long").alias("n_terms"),
        F.array_join("terms", " ").alias("terms"))


def query_validate(spark: Spark, sf: str) -> Frame:
    kinds = F.array(*[F.lit(k) for k in S.KINDS])
    whole = _whole_texts(spark, sf).select(
        (-F.col("query_id") - 1).alias("query_id"),
        kinds[(F.col("query_id") % 4).cast("int")].alias("kind"), "lang", "text")
    good, bad = S.validate(whole.unionByName(I.word_queries(spark, sf)))
    return good.select("query_id", F.lit(None).cast("string").alias("reason")).unionByName(bad)


def highlight_mark(spark: Spark, sf: str) -> Frame:
    terms = F.array(*[F.lit(t) for t in STOP_EN])
    return (I.docs(spark, sf).select("path", mark_words(F.col("body"), terms).alias("body"))
            .select("path", _digest(), F.length("body").cast("long").alias("n_chars")))


# -- index tables --------------------------------------------------------------

def postings(spark: Spark, sf: str) -> Frame:
    return P.postings(I.docs(spark, sf), PLAIN).select(
        "lang", "field", "term", "path", F.col("tf").cast("long").alias("tf"),
        F.array_join("positions", ",").alias("positions"))


def postings_lang_tables(spark: Spark, sf: str) -> Frame:
    """Postings of all documents, bodies not in English by stop-word and stem tables."""
    return P.postings(I.docs(spark, sf), _tabled(spark, sf)).select(
        "lang", "field", "term", "path", F.col("len").cast("long").alias("len"),
        F.col("tf").cast("long").alias("tf"), F.array_join("positions", ",").alias("positions"))


def doc_length(spark: Spark, sf: str) -> Frame:
    return P.doc_lengths(I.docs(spark, sf), PLAIN).select(
        "lang", "field", "path", F.col("len").cast("long").alias("len"),
        kept_length(F.col("len")).cast("long").alias("kept_len"))


def term_stats(spark: Spark, sf: str) -> Frame:
    return P.term_stats(P.postings(I.docs(spark, sf), PLAIN))


def field_stats(spark: Spark, sf: str) -> Frame:
    return P.field_stats(P.doc_lengths(I.docs(spark, sf), PLAIN)).withColumn(
        "avg_len", F.round("avg_len", 4))


def snapshot_tables(spark: Spark, sf: str) -> Frame:
    """What a stored index holds, read back from its newest version."""
    index = I.stored_index(spark, sf)
    parts = [index.docs.select(F.lit("docs").alias("name"), F.lit(1).alias("n")),
             index.postings.select(F.lit("postings").alias("name"), F.col("tf").alias("n")),
             index.term_stats().select(F.lit("terms").alias("name"), F.lit(1).alias("n")),
             index.lengths().select(F.lit("lengths").alias("name"), F.col("len").alias("n"))]
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return every.groupBy("name").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.sum("n").cast("long").alias("total"))


# -- maintenance ---------------------------------------------------------------

def _batch(spark: Spark, sf: str) -> Frame:
    """Labelled documents rewritten, toxic ones twice, and every page as a new document."""
    labelled = (I.docs_with_id(spark, sf).join(I.table(spark, sf, "labels"), "doc_id"))
    text = F.col("body")
    first = labelled.select("path", "lang", "title", F.concat(text, F.lit(" v1")).alias("body"),
                            F.lit(1).alias("seq"))
    second = labelled.filter("toxic = 1").select(
        "path", "lang", "title", F.concat(text, F.lit(" v2")).alias("body"),
        F.lit(2).alias("seq"))
    pages = I.table(spark, sf, "pages").select(
        F.col("url").alias("path"), F.lit("en").alias("lang"), F.col("url").alias("title"),
        F.col("html").alias("body"), F.col("page_id").cast("int").alias("seq"))
    return first.unionByName(second).unionByName(pages)


def upsert(spark: Spark, sf: str) -> Frame:
    batch = maintain.latest(_batch(spark, sf))
    return maintain.upsert(I.docs(spark, sf), batch).select("path", "lang", "title", _digest())


def remove_prefix(spark: Spark, sf: str) -> Frame:
    return maintain.remove_prefixes(I.docs(spark, sf), I.first_folders(spark, sf), RAW).select(
        "path", _digest())


def remove_prefix_segment(spark: Spark, sf: str) -> Frame:
    return maintain.remove_prefixes(I.docs(spark, sf), I.first_folders(spark, sf),
                                    SEGMENT).select("path", _digest())


def remove_exact(spark: Spark, sf: str) -> Frame:
    toxic = I.table(spark, sf, "labels").filter("toxic = 1").select("doc_id")
    gone = I.docs_with_id(spark, sf).join(toxic, "doc_id").select("path")
    return maintain.remove_exact(I.docs(spark, sf), gone).select("path", _digest())


def _signups(spark: Spark, sf: str) -> Frame:
    return I.table(spark, sf, "events").filter("event_type = 'signup'").select(
        (F.col("event_id") + 1_000_000_000).alias("seq"),
        F.concat(F.lit("/corpus/u"), F.col("user_id").cast("string")).alias("path"))


def register_roots(spark: Spark, sf: str) -> Frame:
    known = I.roots(spark, sf)
    again = known.select((F.col("seq") + 2_000_000_000).alias("seq"), "path")
    return maintain.register_roots(known, _signups(spark, sf).unionByName(again))


def unregister_root(spark: Spark, sf: str) -> Frame:
    gone = (I.first_folders(spark, sf).withColumnRenamed("prefix", "path")
            .unionByName(_signups(spark, sf).select("path")))
    left, docs = maintain.unregister_roots(I.roots(spark, sf), I.docs(spark, sf), gone, RAW)
    return (left.select(F.lit("root").alias("what"), "path")
            .unionByName(docs.select(F.lit("doc").alias("what"), "path")))


def reindex(spark: Spark, sf: str) -> Frame:
    docs = I.docs(spark, sf)
    stale = docs.withColumn("body", F.concat(F.lit("old "), "body"))
    roots = I.first_folders(spark, sf).withColumnRenamed("prefix", "path")
    under = maintain.paths_under(docs, I.first_folders(spark, sf), SEGMENT)
    scan = docs.join(under, "path", "left_semi")
    return maintain.reindex(stale, roots, scan, RAW).select("path", "lang", _digest())


def _store(spark: Spark, docs: Frame, roots: Frame | None = None) -> Snapshots:
    store = Snapshots(spark, scratch_path(spark, "store"), PLAIN)
    store.publish(docs, roots)
    return store


def _held(index) -> Frame:
    """Stored documents with the number of their body's terms, read off the stored postings."""
    lengths = index.lengths().filter("field = 'body'").select("path", "len")
    return index.docs.join(lengths, "path", "left").select(
        "path", "lang", "title", _digest(),
        F.coalesce("len", F.lit(0)).cast("long").alias("n_terms"))


def _sizes(store: Snapshots, step: str) -> Frame:
    """What the newest version holds: roots, documents, postings and places."""
    index = store.open()
    parts = [store.roots().select(F.lit("n_roots").alias("name"), F.lit(1).alias("n")),
             index.docs.select(F.lit("n_docs").alias("name"), F.lit(1).alias("n")),
             index.postings.select(F.lit("n_postings").alias("name"), F.lit(1).alias("n")),
             index.postings.select(F.lit("n_places").alias("name"), F.col("tf").alias("n"))]
    names = ["n_roots", "n_docs", "n_postings", "n_places"]
    every = reduce(Frame.unionByName, parts)
    return every.agg(*[F.coalesce(F.sum(F.when(F.col("name") == n, F.col("n"))), F.lit(0))
                       .cast("long").alias(n) for n in names]).select(F.lit(step).alias("step"), *names)


def _prefixed(docs: Frame, mark: str) -> Frame:
    return docs.withColumn("body", F.concat(F.lit(mark), "body"))


def _under(docs: Frame, roots: Frame) -> Frame:
    prefixes = roots.select(F.col("path").alias("prefix"))
    return docs.join(maintain.paths_under(docs, prefixes, SEGMENT), "path", "left_semi")


def store_upsert(spark: Spark, sf: str) -> Frame:
    return _held(_store(spark, I.docs(spark, sf)).upsert(maintain.latest(_batch(spark, sf))))


def store_remove(spark: Spark, sf: str) -> Frame:
    return _held(_store(spark, I.docs(spark, sf)).remove_all(I.first_folders(spark, sf), RAW))


def store_reindex(spark: Spark, sf: str) -> Frame:
    """Old bodies replaced by a scan of the stored roots."""
    docs = I.docs(spark, sf)
    roots = I.roots(spark, sf).join(I.first_folders(spark, sf).withColumnRenamed("prefix", "path"),
                                    "path", "left_semi").select("seq", "path")
    store = _store(spark, _prefixed(docs, "old "), roots)
    return _held(store.reindex(_under(docs, store.roots()), mode=RAW))


def roots_lifecycle(spark: Spark, sf: str) -> Frame:
    """Published, roots registered with a fresh scan, one root taken off, the rest reindexed,
    everything purged: what each version holds."""
    docs = I.docs(spark, sf)
    roots = I.first_folders(spark, sf).withColumnRenamed("prefix", "path")
    store = _store(spark, _prefixed(docs, "old "))
    out = [_sizes(store, "published")]
    store.register(roots, _under(docs, roots))
    out.append(_sizes(store, "registered"))
    store.unregister(roots.agg(F.min("path").alias("path")), RAW)
    out.append(_sizes(store, "unregistered"))
    store.reindex(_under(_prefixed(docs, "new "), store.roots()), mode=RAW)
    out.append(_sizes(store, "reindexed"))
    store.purge()
    return reduce(Frame.unionByName, [*out, _sizes(store, "purged")])


def purge(spark: Spark, sf: str) -> Frame:
    store = _store(spark, I.docs(spark, sf), I.roots(spark, sf))
    before = _sizes(store, "before")
    store.purge()
    return before.unionByName(_sizes(store, "after"))


# -- search --------------------------------------------------------------------

def search_term(spark: Spark, sf: str) -> Frame:
    return S.search_hits(I.stored_index(spark, sf), I.word_queries(spark, sf), [S.TERM]).select(
        "query_id", "path", _score())


def search_phrase(spark: Spark, sf: str) -> Frame:
    return S.search_hits(I.stored_index(spark, sf), I.phrase_queries(spark, sf),
                         [S.PHRASE]).select("query_id", "path", _score())


def search_phrase_gaps(spark: Spark, sf: str) -> Frame:
    return S.search_hits(I.stored_index(spark, sf), I.phrase_queries(spark, sf), [S.PHRASE],
                         gap_aware=True).select("query_id", "path", _score())


def _typos(spark: Spark, sf: str) -> Frame:
    analysed = analyze_queries(I.typo_queries(spark, sf), PLAIN)
    return (S.term_clauses(analysed)
            .select("lang", "field", F.col("term").alias("word")).distinct())


def fuzzy_expand(spark: Spark, sf: str) -> Frame:
    found = lookup.fuzzy_expand(I.stored_index(spark, sf).term_stats(), _typos(spark, sf))
    return found.select("field", "word", "term", "df", F.col("edits").cast("long").alias("edits"),
                        F.round("boost", 4).alias("boost"),
                        F.col("rank").cast("long").alias("rank"), "top_df")


def fuzzy_levenshtein(spark: Spark, sf: str) -> Frame:
    found = lookup.levenshtein_expand(I.stored_index(spark, sf).term_stats(), _typos(spark, sf))
    return found.select("field", "word", "term", F.col("edits").cast("long").alias("edits"))


def search_fuzzy(spark: Spark, sf: str) -> Frame:
    return S.search_hits(I.stored_index(spark, sf), I.typo_queries(spark, sf), [S.FUZZY]).select(
        "query_id", "path", _score())


def search_prefix(spark: Spark, sf: str) -> Frame:
    return S.search_hits(I.stored_index(spark, sf), I.folder_queries(spark, sf),
                         [S.PREFIX]).select("query_id", "path", _score())


def search_bool_parts(spark: Spark, sf: str) -> Frame:
    hits = S.clause_hits(I.stored_index(spark, sf), I.word_queries(spark, sf), [S.TERM])[S.TERM]

    def part(name: str):
        return F.round(F.sum(F.when(F.col("field") == name, F.col("score"))), 4)

    return hits.groupBy("query_id", "path").agg(
        part("body").alias("body_score"), part("title").alias("title_score"),
        F.count(F.lit(1)).alias("n_clauses"))


def search_lang(spark: Spark, sf: str) -> Frame:
    """Each word asked in every language of the documents."""
    asked = I.words(spark, sf).select(
        "query_id", F.lit("term").alias("kind"),
        F.explode(F.array(*[F.lit(x) for x in ("en", "de", "es", "fr")])).alias("lang"),
        F.col("word").alias("text"))
    keyed = asked.withColumn("query_id", F.concat_ws(":", "lang", "query_id"))
    return S.search_hits(I.stored_index(spark, sf), keyed, [S.TERM]).select(
        "query_id", "path", _score())


def search_stemmed(spark: Spark, sf: str) -> Frame:
    """Each word in an index of stemmed English bodies, the default analysis."""
    index = I.stored_index(spark, sf, DEFAULT, "stemmed")
    return S.search_hits(index, I.word_queries(spark, sf), [S.TERM]).select(
        "query_id", "path", _score())


def search_lang_tables(spark: Spark, sf: str) -> Frame:
    """Each word in the other languages, bodies analysed by tables when indexed and when asked."""
    index = I.stored_index(spark, sf, _tabled(spark, sf), "tables")
    asked = I.words(spark, sf).select(
        "query_id", F.lit("term").alias("kind"),
        F.explode(F.array(*[F.lit(x) for x in I.OTHER_LANGS])).alias("lang"),
        F.col("word").alias("text"))
    keyed = asked.withColumn("query_id", F.concat_ws(":", "lang", "query_id"))
    return S.search_hits(index, keyed, [S.TERM]).select("query_id", "path", _score())


def bm25_scores(spark: Spark, sf: str) -> Frame:
    index = I.stored_index(spark, sf)
    scored = (lookup.with_df(index.postings, index.term_stats())
              .join(F.broadcast(index.field_stats()), ["lang", "field"]))
    weight = lookup.idf(F.col("n_docs"), F.col("df"))
    score = lookup.bm25(weight, F.col("tf"), index.norm(F.col("len")), F.col("avg_len"))
    return scored.select("lang", "field", "term", "path", F.round(score, 4).alias("score"))


def hit_counts(spark: Spark, sf: str) -> Frame:
    return S.search(I.stored_index(spark, sf), I.word_queries(spark, sf), kinds=[S.TERM]).counts


def search_ranked(spark: Spark, sf: str) -> Frame:
    found = S.search(I.stored_index(spark, sf), I.word_queries(spark, sf), None, kinds=[S.TERM])
    return found.hits.select("query_id", "path", F.col("rank").cast("long").alias("rank"))


def _top(spark: Spark, sf: str) -> Frame:
    return S.search(I.stored_index(spark, sf), I.word_queries(spark, sf), TOP,
                    kinds=[S.TERM]).hits


def search_topk(spark: Spark, sf: str) -> Frame:
    return _top(spark, sf).select("query_id", "path", F.col("rank").cast("long").alias("rank"),
                                  _score())


def search_fetch(spark: Spark, sf: str) -> Frame:
    index, queries = I.stored_index(spark, sf), I.word_queries(spark, sf)
    rows, top = TOP * queries.count(), materialize(_top(spark, sf), "top")
    hits = ranking.fetch(top, index.docs_of(top, rows), ["title", "body"], rows)
    return hits.select("query_id", F.col("rank").cast("long").alias("rank"), "path", "title",
                       _digest())


def fragments(spark: Spark, sf: str) -> Frame:
    return snippets.fragments(snippets.cut_bodies(I.docs(spark, sf), PLAIN)).select(
        "path", *[F.col(c).cast("long").alias(c) for c in ("frag_no", "start", "end")])


def _fragment_scores(spark: Spark, sf: str) -> Frame:
    index, queries = I.stored_index(spark, sf), I.word_queries(spark, sf)
    rows, top = TOP * queries.count(), materialize(_top(spark, sf), "top")
    hits = top.select("query_id", "path")
    wanted = hits.join(S.wanted_terms(index, queries, [S.TERM]), "query_id")
    shown = broadcast_within(hits.select("path").distinct(), rows)
    bodies = index.docs_of(hits, rows).join(shown, "path", "left_semi")
    return snippets.fragment_scores(snippets.words_of_cut(snippets.cut_bodies(bodies, PLAIN)), wanted)


def fragment_scores(spark: Spark, sf: str) -> Frame:
    return _fragment_scores(spark, sf).select(
        "query_id", "path", F.col("frag_no").cast("long").alias("frag_no"), _score(),
        F.size("marks").cast("long").alias("n_marks"))


def snippets_top(spark: Spark, sf: str) -> Frame:
    best = snippets.best_fragments(_fragment_scores(spark, sf))
    return best.select("query_id", "path", F.col("frag_no").cast("long").alias("frag_no"),
                       F.col("place").cast("long").alias("place"))


def snippets_merged(spark: Spark, sf: str) -> Frame:
    index, queries = I.stored_index(spark, sf), I.word_queries(spark, sf)
    found = S.search(index, queries, TOP, details=True, kinds=[S.TERM]).snippets
    return found.select("query_id", "path", F.col("rank").cast("long").alias("rank"),
                        F.col("frag_rank").cast("long").alias("frag_rank"),
                        F.col("frag_no").cast("long").alias("frag_no"), "text")


def snippets_phrase(spark: Spark, sf: str) -> Frame:
    index, queries = I.stored_index(spark, sf), I.phrase_queries(spark, sf)
    found = S.search(index, queries, TOP, details=True, kinds=[S.PHRASE], gap_aware=True).snippets
    return found.select("query_id", "path", F.col("rank").cast("long").alias("rank"),
                        F.col("frag_rank").cast("long").alias("frag_rank"),
                        F.col("frag_no").cast("long").alias("frag_no"), "text")


def mixed_queries(spark: Spark, sf: str) -> Frame:
    return (I.word_queries(spark, sf).unionByName(I.phrase_queries(spark, sf))
            .unionByName(I.typo_queries(spark, sf)).unionByName(I.folder_queries(spark, sf)))


def search_batch(spark: Spark, sf: str) -> Frame:
    found = S.search(I.stored_index(spark, sf), mixed_queries(spark, sf), TOP)
    return found.hits.select("query_id", "path", F.col("rank").cast("long").alias("rank"),
                             _score())


def _suggested(spark: Spark, sf: str, inside: bool) -> Frame:
    vocabulary = I.stored_index(spark, sf).term_stats().filter(
        "lang = 'en' AND field = 'body'")
    asked = I.words(spark, sf).select(F.substring("word", 1, 3).alias("prefix"))
    return suggest_terms(vocabulary, asked, inside=inside).withColumn(
        "rank", F.col("rank").cast("long"))


def suggest_terms_(spark: Spark, sf: str) -> Frame:
    return _suggested(spark, sf, False)


def suggest_inside(spark: Spark, sf: str) -> Frame:
    return _suggested(spark, sf, True)


# -- changes -------------------------------------------------------------------

def change_counts(spark: Spark, sf: str) -> Frame:
    return changes.change_counts(I.change_events(spark, sf))


def snapshot_diff(spark: Spark, sf: str) -> Frame:
    """Toxic documents gone, those of quality longer by one, every page new."""
    docs = I.docs_with_id(spark, sf).select("doc_id", "path", F.length("body").alias("length"))
    labelled = docs.join(I.table(spark, sf, "labels"), "doc_id", "left")
    new = labelled.filter(F.coalesce("toxic", F.lit(0)) != 1).select(
        "path", (F.col("length") + F.coalesce("quality", F.lit(0))).alias("length"))
    pages = I.table(spark, sf, "pages").select(F.col("url").alias("path"),
                                               F.length("html").alias("length"))
    return changes.snapshot_diff(docs, new.unionByName(pages), ["length"])


def fold_changes(spark: Spark, sf: str) -> Frame:
    events = I.change_events(spark, sf)
    parts = [changes.fold_changes(events, mode).select(F.lit(mode).alias("mode"), "seq", "path",
                                                       "body") for mode in (RAW, SEGMENT)]
    return parts[0].unionByName(parts[1])


def _event_stream(spark: Spark, sf: str) -> Frame:
    schema = I.table(spark, sf, "events").schema
    return I.changes_of(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
                        .parquet(sf))


def apply_changes(spark: Spark, sf: str) -> Frame:
    """The events as a stream into an empty index; its documents and terms afterwards."""
    target = Snapshots(spark, scratch_path(spark, "changes"), PLAIN)
    run_changes(_event_stream(spark, sf), target, scratch_path(spark, "offsets"), SEGMENT).wait()
    index = target.open()
    lengths = index.lengths().filter("field = 'body'").select("path", "len")
    return index.docs.join(lengths, "path").select(
        "path", "title", "body", F.col("len").cast("long").alias("n_terms"))


def stream_roots(spark: Spark, sf: str) -> Frame:
    """The files users signed up with are the roots, an error deletes one: what the stream leaves
    of documents and roots, each watched until it is deleted."""
    target = Snapshots(spark, scratch_path(spark, "watched"), PLAIN)
    file = F.concat(F.lit("/"), (F.col("seq") % 5).cast("string"), F.lit(".txt"))
    roots = _signups(spark, sf).select("seq", F.concat("path", file).alias("path"))
    target.register(roots, I.docs(spark, sf).limit(0))
    events = _event_stream(spark, sf).withColumn("path", F.when(
        F.col("kind") == changes.DELETE, F.concat("path", file)).otherwise(F.col("path")))
    run_changes(events, target, scratch_path(spark, "offsets"), SEGMENT, watched=True).wait()
    return (target.open().docs.select(F.lit("doc").alias("what"), "path", _digest())
            .unionByName(target.roots().select(F.lit("root").alias("what"), "path",
                                               F.lit(None).cast("string").alias("digest"))))


def overflow_reconcile(spark: Spark, sf: str) -> Frame:
    """Old bodies, a stream that tells of overflow, and the documents as they are."""
    target = _store(spark, _prefixed(I.docs(spark, sf), "old "))
    run_changes(_event_stream(spark, sf), target, scratch_path(spark, "offsets"), SEGMENT,
                listing=lambda: I.docs(spark, sf)).wait()
    return _held(target.open())


def events_in_roots(spark: Spark, sf: str) -> Frame:
    """Roots are the folders of users who signed up."""
    events = I.change_events(spark, sf)
    live = _signups(spark, sf).select("path").distinct()
    return changes.events_in_roots(events, live, SEGMENT).select("seq", "kind", "path")


QUERIES = {f.__name__.rstrip("_"): f for f in (
    scan_docs, scan_tree, media_type_counts, media_type_filter, extract_text, extractor_hook, list_roots,
    title_terms, tokenize, tokenize_joined, analyze_en_stop, analyze_en_stem, analyze_lang_tables, lang_detect,
    lang_route, analyze_queries_, query_validate, highlight_mark, postings, postings_lang_tables, doc_length,
    term_stats, field_stats, snapshot_tables, upsert, remove_prefix, remove_prefix_segment,
    remove_exact, register_roots, unregister_root, reindex, store_upsert, store_remove, store_reindex,
    roots_lifecycle, purge, search_term, search_phrase,
    search_phrase_gaps, fuzzy_expand, fuzzy_levenshtein, search_fuzzy, search_prefix,
    search_bool_parts, search_lang, search_stemmed, search_lang_tables, bm25_scores, hit_counts, search_ranked, search_topk,
    search_fetch, fragments, fragment_scores, snippets_top, snippets_merged, snippets_phrase,
    search_batch, suggest_terms_, suggest_inside, change_counts, snapshot_diff, fold_changes, apply_changes,
    stream_roots, overflow_reconcile, events_in_roots)}
