"""Batch search: a table of queries of mixed kinds against one index."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexharbor.operators import lookup, ranking, snippets
from lexharbor.operators.analysis import single_term
from lexharbor.operators.vocabulary import analyze_queries, settled
from lexharbor.plans.index import Index
from lexharbor.session import BROADCAST_ROWS, broadcast_within, count_up_to, materialize

# Kinds of query.
TERM, PHRASE, FUZZY, PREFIX = "term", "phrase", "fuzzy", "prefix"
KINDS = (TERM, PHRASE, FUZZY, PREFIX)


@dataclass
class Found:
    """``hits(query_id, path, score, rank)``, ``counts(query_id, n_hits)``,
    ``rejected(query_id, reason)`` and, if asked for, ``snippets``."""

    hits: DataFrame
    counts: DataFrame
    rejected: DataFrame
    snippets: DataFrame | None = None


def validate(queries: DataFrame, kinds=KINDS) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected(query_id, reason))``: every query is in one of the two.

    Rejected are kinds that are null, unknown or not among ``kinds``, null and empty texts,
    and spaces in anything but a phrase.
    """
    kind, text = F.col("kind"), F.col("text")
    reason = (F.when(kind.isNull(), F.lit("no kind given"))
              .when(~kind.isin(*KINDS), F.concat(F.lit("unknown kind "), kind))
              .when(~kind.isin(*kinds), F.concat(F.lit("kind not asked for: "), kind))
              .when(text.isNull() | (text == ""), F.lit("nothing to look for"))
              .when((kind != PHRASE) & text.contains(" "),
                    F.concat(F.lit("one word expected in a query of kind "), kind)))
    judged = queries.withColumn("reason", reason)
    return (judged.filter("reason is null").drop("reason"),
            judged.filter("reason is not null").select("query_id", "reason"))


def term_clauses(analysed: DataFrame) -> DataFrame:
    """``(query_id, lang, field, term)``: the one term a word query has in each field."""
    return analysed.select("query_id", "lang", "field",
                           single_term(F.col("terms"), F.col("text")).alias("term"))


def phrase_clauses(analysed: DataFrame, gap_aware: bool = False) -> DataFrame:
    """``(query_id, lang, field, tokens)`` with the place each term must take.

    Places count on without gaps where stop words were dropped, so a phrase with an
    inner stop word cannot match its own text in a field that drops them;
    ``gap_aware`` keeps the true distances instead.
    """
    first = F.col("tokens")[0]["pos"]
    place = (lambda t, i: t["pos"] - first) if gap_aware else (lambda t, i: i)
    tokens = F.transform("tokens", lambda t, i: F.struct(
        t["term"].alias("term"), place(t, i).alias("pos")))
    return (analysed.filter(F.size("tokens") > 0)
            .select("query_id", "lang", "field", tokens.alias("tokens")))


def clause_hits(index: Index, queries: DataFrame, kinds=KINDS, gap_aware: bool = False,
                expansions: int = lookup.MAX_EXPANSIONS) -> dict[str, DataFrame]:
    """Scored clause rows by kind; one plan per kind asked for."""
    analysed = analyze_queries(queries, index.registry)
    out = {}
    for kind in kinds:
        mine = analysed.filter(F.col("kind") == kind)
        if kind == TERM:
            out[kind] = lookup.term_hits(index, term_clauses(mine))
        elif kind == FUZZY:
            out[kind] = lookup.fuzzy_hits(index, term_clauses(mine), expansions)
        elif kind == PHRASE:
            out[kind] = lookup.phrase_hits(index, phrase_clauses(mine, gap_aware))
        else:
            out[kind] = lookup.prefix_hits(index.docs, queries.filter(F.col("kind") == kind))
    return out


def search_hits(index: Index, queries: DataFrame, kinds=KINDS, gap_aware: bool = False,
                expansions: int = lookup.MAX_EXPANSIONS) -> DataFrame:
    """``(query_id, path, score)``: body and title clauses joined by OR.

    Queries of several kinds may share a ``query_id``; only then are hits added across kinds.
    """
    several = len(kinds) > 1 and not (
        queries.filter(F.col("kind").isin(*kinds)).groupBy("query_id")
        .agg(F.count_distinct("kind").alias("n")).filter("n > 1").isEmpty())
    return lookup.either_clause(
        *clause_hits(index, queries, kinds, gap_aware, expansions).values(), apart=not several)


def search(index: Index, queries: DataFrame, k: int | None = None, details: bool = False,
           kinds=KINDS, gap_aware: bool = False, pre: str = "<b>", post: str = "</b>",
           expansions: int = lookup.MAX_EXPANSIONS, best: int = snippets.BEST) -> Found:
    """Run ``queries(query_id, kind, lang, text)``; those of kinds not in ``kinds`` are rejected.

    ``k`` limits the hits shown per query, not those counted; ``None`` or 0 shows all.
    ``details`` adds snippets of the hits shown, of the ``best`` fragments each. A fuzzy word
    stands for its ``expansions`` nearest terms.
    """
    k = ranking.check_limit(k)
    accepted, rejected = validate(queries, kinds)
    hits = search_hits(index, accepted, kinds, gap_aware, expansions)
    if k is None:
        # ranking everything reads the hits several times: look them up once
        hits = materialize(hits, "hits")
    n_queries = count_up_to(queries, BROADCAST_ROWS)
    shown = ranking.ranked(hits, k)
    if details:
        # the snippets read the hits shown several times
        shown = materialize(shown, "shown")
    found = Found(shown, ranking.hit_counts(hits), rejected)
    if details:
        bound = BROADCAST_ROWS + 1 if k is None else k * n_queries
        found.snippets = snippets_of(index, accepted, shown, bound, kinds, gap_aware, pre, post,
                                     expansions, best)
    return found


def wanted_terms(index: Index, queries: DataFrame, kinds=KINDS,
                 expansions: int = lookup.MAX_EXPANSIONS) -> DataFrame:
    """``(query_id, term, weight)`` to look for in bodies, from either field's terms."""
    analysed = analyze_queries(queries, index.registry)
    parts = []
    if TERM in kinds:
        parts.append(term_clauses(analysed.filter(F.col("kind") == TERM))
                     .select("query_id", "term", F.lit(1.0).alias("weight")))
    if FUZZY in kinds:
        asked = term_clauses(analysed.filter(F.col("kind") == FUZZY))
        words = asked.select("lang", "field", F.col("term").alias("word")).distinct()
        near = index.expansions(words, expansions)
        parts.append(asked.withColumnRenamed("term", "word")
                     .join(near, ["lang", "field", "word"])
                     .select("query_id", "term", F.col("boost").alias("weight")))
    if not parts:
        return analysed.select("query_id", F.lit("").alias("term"),
                               F.lit(0.0).alias("weight")).limit(0)
    every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return every.groupBy("query_id", "term").agg(F.max("weight").alias("weight"))


def winning_fragments(index: Index, queries: DataFrame, shown: DataFrame, rows: int,
                      kinds=KINDS, gap_aware: bool = False,
                      expansions: int = lookup.MAX_EXPANSIONS,
                      n: int = snippets.BEST) -> DataFrame:
    """``(query_id, path, frag_no, n_frags, score, start, end, marks)`` of hits shown."""
    hits = shown.select("query_id", "path")
    parts = []
    if TERM in kinds or FUZZY in kinds:
        # fragments of a document are the same for every such query: cut once per path
        bodies = _bodies(index, hits.select("path").distinct(), rows)
        cut = snippets.cut_bodies(bodies, index.registry)
        wanted = hits.join(wanted_terms(index, queries, kinds, expansions), "query_id")
        best = snippets.best_fragments(snippets.fragment_scores(
            _words(index, cut), wanted), n)
        parts.append(snippets.merged(best, snippets.fragments(cut)))
    if PHRASE in kinds:
        keys = ("query_id", "path")
        phrases = phrase_clauses(analyze_queries(
            queries.filter(F.col("kind") == PHRASE), index.registry), gap_aware)
        matched = lookup.phrase_hits(index, phrases).join(
            broadcast_within(hits, rows), ["query_id", "path"], "left_semi")
        places = snippets.phrase_places(matched, phrases)
        bodies = _bodies(index, matched.select("query_id", "path").distinct(), rows)
        cut = snippets.cut_bodies(bodies, index.registry, keys, places.filter("place > 0"))
        best = snippets.best_fragments(snippets.fragment_scores(
            _words(index, cut, keys), places.drop("place").distinct(), keys), n)
        parts.append(snippets.merged(best, snippets.fragments(cut, keys), keys))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _words(index: Index, cut: DataFrame, keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """Words of the bodies cut, by the terms the index knows them under."""
    words = snippets.words_of_cut(cut, (*keys, "lang")).withColumn("field", F.lit("body"))
    return settled(words, index.registry).drop("lang", "field")


def _bodies(index: Index, hits: DataFrame, rows: int) -> DataFrame:
    docs = index.docs_of(hits, rows).select("path", "lang", "body")
    return docs.join(broadcast_within(hits, rows), "path")


def snippets_of(index: Index, queries: DataFrame, shown: DataFrame, rows: int, kinds=KINDS,
                gap_aware: bool = False, pre: str = "<b>", post: str = "</b>",
                expansions: int = lookup.MAX_EXPANSIONS, best: int = snippets.BEST) -> DataFrame:
    """``(query_id, path, rank, frag_rank, frag_no, score, text)``: snippets of the hits shown.

    ``frag_rank`` counts a hit's fragments best first, equal scores by place in the text. A hit
    without any (a path match, another field's match) keeps one row with no text. ``rows``
    bounds ``shown``.
    """
    won = winning_fragments(index, queries, shown, rows, kinds, gap_aware, expansions, best)
    base = shown.select("query_id", "path", "rank")
    if won is None:
        return base.select("*", F.lit(None).cast("int").alias("frag_rank"),
                           F.lit(None).cast("int").alias("frag_no"),
                           F.lit(None).cast("double").alias("score"),
                           F.lit(None).cast("string").alias("text"))
    order = Window.partitionBy("query_id", "path").orderBy(F.desc("score"), "frag_no")
    won = materialize(won.withColumn("frag_rank", F.row_number().over(order)), "fragments")
    texts = (index.docs_of(won, rows).select("path", "body")
             .join(broadcast_within(won, rows * best), "path")
             .select("query_id", "path", "frag_rank", "frag_no", F.col("score"), snippets.marked_text(
                 F.col("body"), F.col("start"), F.col("end"), F.col("marks"), pre, post)
                 .alias("text")))
    return base.join(texts, ["query_id", "path"], "left")
