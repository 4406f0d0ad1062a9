"""Inverted index tables: postings, lengths, term and field statistics."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexharbor.operators import vocabulary
from lexharbor.operators.analysis import DEFAULT, FIELDS, Registry, field_tokens
from lexharbor.session import BROADCAST_ROWS, count_up_to, least_level


def postings(docs: DataFrame, registry: Registry = DEFAULT, *carry: str,
             known: DataFrame | None = None) -> DataFrame:
    """``(path, lang, field, len, term, tf, first, positions)`` from document rows.

    Built inside each document row: sort its tokens by (term, pos), find where a
    term starts, cut the runs. No shuffle, so a term in a third of all documents
    costs no more than its rows. ``len`` rides along to spare the ranking a join;
    ``first`` marks one posting per document and field, so that lengths and document
    counts can be read off the postings.

    Where stem rules or tables apply, the distinct terms are looked up once and the postings
    of terms that fall together merged by :func:`merged`; ``known`` gives what :func:`known_terms`
    of the same documents found. Few terms that change are broadcast, of many that stem rules
    change the commonest, so that documents stay in the task they are in; with a column of ``carry``
    by which they were dealt, nothing is shuffled. Many that tables change are joined by term.
    """
    if not registry.resolves():
        return postings_of_tokens(field_tokens(docs, registry, *carry), *carry)
    known = known_terms(docs, registry) if known is None else known
    changed = vocabulary.changed(known)
    if count_up_to(changed, BROADCAST_ROWS) <= BROADCAST_ROWS:
        resolve, by = vocabulary.resolve, F.broadcast(changed)
    elif registry.tables is not None:
        resolve, by = vocabulary.resolve, changed
    else:
        least = least_level(known, "n", BROADCAST_ROWS)
        resolve, by = vocabulary.resolve_rare, known.filter(
            F.lit(False) if least is None else F.col("n") >= least)
    parts = []
    for tokens, settled in _tokens_by_rule(docs, registry, *carry):
        rows = postings_of_tokens(tokens, *carry)
        parts.append(merged(resolve(rows, by), *carry) if settled else rows)
    return reduce(DataFrame.unionByName, parts)


def shuffles(known: DataFrame, registry: Registry) -> bool:
    """Whether :func:`postings` takes documents out of the tasks they were dealt to."""
    return registry.tables is not None and count_up_to(
        vocabulary.changed(known), BROADCAST_ROWS) > BROADCAST_ROWS


def _tokens_by_rule(docs: DataFrame, registry: Registry,
                    *carry: str) -> Iterator[tuple[DataFrame, bool]]:
    """Tokens of each field, those apart whose terms stem rules or tables settle.

    Every text is cut in one of the parts only.
    """
    for name in FIELDS:
        langs, rest = registry.resolved_langs(name), docs
        if langs:
            ruled = F.col("lang").isin(*langs)
            yield field_tokens(docs.filter(ruled), registry, *carry, names=(name,)), True
            rest = docs.filter(~ruled)
        yield field_tokens(rest, registry, *carry, names=(name,)), False


def known_terms(docs: DataFrame, registry: Registry = DEFAULT) -> DataFrame:
    """What stem rules and tables make of the terms of ``docs``, by :func:`vocabulary.term_map`."""
    terms = [tokens.select("lang", "field", F.explode_outer(F.array_distinct(
                 F.transform("tokens", lambda t: t["term"]))).alias("term"))
             for tokens, settled in _tokens_by_rule(docs, registry) if settled]
    return vocabulary.term_map(reduce(DataFrame.unionByName, terms).filter("term is not null"),
                               registry)


def merged(rows: DataFrame, *carry: str) -> DataFrame:
    """Postings of which several may name one term of a document, as proper postings.

    Frequencies add up and positions interleave; length and ``first`` are taken anew. Rows are
    grouped by document, so no frequent term gathers in one task.
    """
    keys = ["path", "lang", "field", *carry]
    places = F.transform("positions", lambda p: F.struct(F.col("term"), p.alias("pos")))
    tokens = rows.groupBy(*keys).agg(F.flatten(F.collect_list(places)).alias("tokens"))
    return postings_of_tokens(tokens, *carry)


def postings_of_tokens(tokens: DataFrame, *carry: str) -> DataFrame:
    """As :func:`postings`, from ``(path, lang, field, tokens)`` rows."""
    keys = ["path", "lang", "field", *carry]
    ordered = (tokens.filter(F.size("tokens") > 0)
               .select(*keys, F.size("tokens").alias("len"),
                       F.sort_array("tokens").alias("t")))
    heads = ordered.withColumn(
        "heads",
        F.filter(F.sequence(F.lit(0), F.col("len") - 1),
                 lambda i: (i == 0) | (F.col("t")[i]["term"] != F.col("t")[i - 1]["term"])))
    runs = heads.withColumn("ends", F.concat(
        F.slice("heads", 2, F.size("heads")), F.array(F.col("len"))))
    rows = F.transform(
        F.arrays_zip(F.col("heads").alias("a"), F.col("ends").alias("b")),
        lambda r: F.struct(
            F.col("t")[r["a"]]["term"].alias("term"),
            (r["b"] - r["a"]).alias("tf"),
            (r["a"] == 0).alias("first"),
            F.transform(F.slice("t", r["a"] + 1, r["b"] - r["a"]),
                        lambda x: x["pos"]).alias("positions")))
    return runs.select(*keys, "len", F.inline(rows))


def lengths_of(postings: DataFrame) -> DataFrame:
    """``(lang, field, path, len)`` read off the postings."""
    return postings.filter("first").select("lang", "field", "path", "len")


def doc_lengths(docs: DataFrame, registry: Registry = DEFAULT) -> DataFrame:
    """``(lang, field, path, len)`` of fields with at least one term."""
    if registry.tables is not None:
        return lengths_of(postings(docs, registry))
    return (field_tokens(docs, registry)
            .select("lang", "field", "path", F.size("tokens").alias("len"))
            .filter("len > 0"))


def term_stats(postings: DataFrame) -> DataFrame:
    """``(lang, field, term, df, ttf)``: partial counts before the shuffle."""
    return (postings.groupBy("lang", "field", "term")
            .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("ttf")))


def field_stats(lengths: DataFrame) -> DataFrame:
    """``(lang, field, n_docs, sum_len, avg_len)``, one row per field and language."""
    return (lengths.groupBy("lang", "field")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("len").cast("long").alias("sum_len"))
            .withColumn("avg_len", F.col("sum_len") / F.col("n_docs")))
