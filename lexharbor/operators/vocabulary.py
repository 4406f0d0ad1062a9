"""Analysis by vocabulary: stop words and stems looked up once per distinct term.

Tokens are cut in the document's row by column expressions. What a language's tables or stem rules
make of a term is then settled on the distinct terms alone and joined back, so no rule runs once
per occurrence, and no Python on texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexharbor.functions.stem_en import stems
from lexharbor.operators.analysis import (
    DEFAULT, STANDARD, Analyzer, Registry, explode_tokens, query_tokens)
from lexharbor.session import materialize

KEY = ["lang", "field", "term"]


def stem_map(terms: DataFrame) -> DataFrame:
    """``terms`` with ``stem``, stored: a filter above may not be pushed into the rules."""
    return materialize(stems(terms), "stems")


def term_map(terms: DataFrame, registry: Registry) -> DataFrame:
    """``(lang, field, term, to, n)``: the terms that change; ``to`` is null for stop words.

    ``terms(lang, field, term)`` may repeat, ``n`` times; each distinct one is looked up once. The
    result is stored, so a join with it knows its true size: a small one is broadcast, a large one
    shuffled and its hot terms split. Terms that stem rules leave as they are stay in, as ``to``.
    """
    terms = terms.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    parts = []
    ruled = F.lit(False)
    for (name, lang), analyzer in registry.bound.items():
        if analyzer.stem:
            ruled = ruled | ((F.col("field") == name) & (F.col("lang") == lang))
    if any(a.stem for a in registry.bound.values()):
        found = stem_map(terms.filter(ruled))
        parts.append(found.select(*KEY, F.col("stem").alias("to"), "n"))
    if registry.tables is not None:
        tables = registry.tables
        mine = terms.filter((F.col("field") == "body") & F.col("lang").isin(*tables.langs))
        stop = tables.stopwords.select("lang", "term", F.lit(True).alias("stop")).distinct()
        one = tables.stems.groupBy("lang", "term").agg(F.min("stem").alias("stem"))
        looked = mine.join(stop, ["lang", "term"], "left").join(one, ["lang", "term"], "left")
        parts.append(looked.filter("stop or stem <> term").select(
            *KEY, F.when(F.col("stop").isNull(), F.col("stem")).alias("to"), "n"))
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return materialize(every, "vocabulary")


def changed(known: DataFrame) -> DataFrame:
    """The terms of a :func:`term_map` that change."""
    return known.filter("to is null or to <> term")


def resolve_rare(rows: DataFrame, common: DataFrame) -> DataFrame:
    """``rows(lang, field, term, …)`` of terms under stem rules alone, each replaced by its stem.

    Those of the ``common`` terms, all of a :func:`term_map` that are commoner than some others,
    are looked up; to the rarer terms the rules are applied in their rows.
    """
    looked = rows.join(F.broadcast(common.select(*KEY, "to")), KEY, "left").withColumn(
        "rare", F.when(F.col("to").isNull(), F.col("term")))
    return stems(looked, "rare").select(*[
        F.coalesce("to", "stem").alias("term") if c == "term" else F.col(c) for c in rows.columns])


def resolve(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows(lang, field, term, …)`` with terms replaced, and without those that are dropped."""
    marked = changed(known).select(*KEY, "to", F.lit(True).alias("changes"))
    joined = rows.join(marked, KEY, "left").filter("changes is null or to is not null")
    return joined.select(*[F.coalesce("to", "term").alias("term") if c == "term" else F.col(c)
                           for c in rows.columns])


def resolve_terms(rows: DataFrame, analyzer: Analyzer) -> DataFrame:
    """``rows(term, …)`` of one analyzer with its stem rules applied."""
    if not analyzer.stem:
        return rows
    known = stem_map(rows.select("term").distinct()).filter("stem <> term")
    return rows.join(known, "term", "left").select(
        *[F.coalesce("stem", "term").alias("term") if c == "term" else F.col(c)
          for c in rows.columns])


def analyze(df: DataFrame, key: str, text: str, analyzer: Analyzer = STANDARD) -> DataFrame:
    """``(key, pos, term)`` of every row's text."""
    rows = df.select(key, analyzer.tokens(F.col(text)).alias("tokens"))
    return resolve_terms(explode_tokens(rows, key), analyzer)


def settled(rows: DataFrame, registry: Registry) -> DataFrame:
    """``rows(lang, field, term, …)`` with every term looked up in the vocabulary of ``rows``."""
    return resolve(rows, term_map(rows, registry)) if registry.resolves() else rows


def analyze_queries(queries: DataFrame, registry: Registry = DEFAULT) -> DataFrame:
    """``(query_id, kind, lang, field, text, tokens, terms)``: terms of a query in each field."""
    cut = query_tokens(queries, registry)
    if registry.resolves():
        keys = ["query_id", "lang", "field"]
        words = settled(explode_tokens(cut, *keys), registry)
        whole = words.groupBy(*keys).agg(
            F.sort_array(F.collect_list(F.struct("pos", "term"))).alias("t"))
        tokens = F.transform("t", lambda t: F.struct(t["term"].alias("term"), t["pos"].alias("pos")))
        none = F.array().cast("array<struct<term: string, pos: int>>")
        cut = (cut.drop("tokens").join(whole, keys, "left")
               .withColumn("tokens", F.coalesce(tokens, none)))
    return cut.select("query_id", "kind", "lang", "field", "text", "tokens",
                      F.transform("tokens", lambda t: t["term"]).alias("terms"))
