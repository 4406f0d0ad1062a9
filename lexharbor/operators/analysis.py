"""Analyzers: text column in, ``array<struct<term, pos>>`` column out.

An analyzer is a column expression, so words are cut in the row that holds the
text, without a shuffle, and queries are analysed by the same expression as
documents. ``Registry`` binds one analyzer to each (field, language). Stem rules and
stop-word and stem tables apply to distinct terms, in :mod:`lexharbor.operators.vocabulary`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexharbor.functions import text as T

# The English stop words.
STOP_EN = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into",
    "is", "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then",
    "there", "these", "they", "this", "to", "was", "will", "with",
)

FIELDS = ("body", "title")


@dataclass(frozen=True)
class Analyzer:
    """Tokenise and lowercase, then optionally drop possessives and stop words.

    Dropped stop words leave gaps in the positions. ``stem`` asks for the English stem rules,
    which are applied to the vocabulary afterwards. Any object with ``tokens`` and ``spans``
    methods of this shape and a ``stem`` can stand in for it.
    """

    pattern: str = T.WORDS
    possessive: bool = False
    stop: tuple[str, ...] = ()
    stem: bool = False

    def tokens(self, text: Column) -> Column:
        on_token = self.possessive and self.pattern != T.WORDS
        if self.possessive and not on_token:
            text = F.regexp_replace(text, T.POSSESSIVE_IN_TEXT, "$1$2")

        def clean(word: Column) -> Column:
            if on_token:
                word = F.regexp_replace(word, T.POSSESSIVE_ON_TOKEN, "")
            return F.lower(word)

        out = F.transform(T.words_of(text, self.pattern),
                          lambda w, i: F.struct(clean(w).alias("term"), i.alias("pos")))
        if self.stop:
            out = F.filter(out, lambda t: ~t["term"].isin(*self.stop))
        return out

    def spans(self, text: Column) -> Column:
        """``array<struct<k, gap, size, tail, term>>``: every word with its lengths.

        ``gap`` counts the characters before the word, ``size`` its own; ``term`` is null
        for dropped words; ``tail`` marks a possessive ending, which takes no position.
        """
        split_tail = self.possessive and self.pattern == T.WORDS

        def tail(p: Column, k: Column) -> Column:
            ending = p["gap"].isin(*T.APOSTROPHES) & (F.lower(p["word"]) == "s") & (k > 0)
            return F.coalesce(ending, F.lit(False)) if split_tail else F.lit(False)

        def term(p: Column, k: Column) -> Column:
            word = p["word"]
            if self.possessive and not split_tail:
                word = F.regexp_replace(word, T.POSSESSIVE_ON_TOKEN, "")
            word = F.lower(word)
            keep = word.isNotNull() & ~tail(p, k)
            return F.when(keep & ~word.isin(*self.stop) if self.stop else keep, word)

        return F.transform(T.pieces_of(text, self.pattern), lambda p, k: F.struct(
            k.alias("k"), F.length(p["gap"]).alias("gap"),
            F.coalesce(F.length(p["word"]), F.lit(0)).alias("size"),
            tail(p, k).alias("tail"), term(p, k).alias("term")))


STANDARD = Analyzer()
ENGLISH_STOP = Analyzer(possessive=True, stop=STOP_EN)
ENGLISH = Analyzer(possessive=True, stop=STOP_EN, stem=True)


@dataclass(frozen=True)
class Tables:
    """Stop words and stems of bodies in ``langs``, for languages with no built-in rules.

    ``stopwords(lang, term)`` and ``stems(lang, term, stem)``; a term with several stems takes
    the least. A dropped word leaves a gap in the positions.
    """

    langs: tuple[str, ...]
    stopwords: DataFrame
    stems: DataFrame


@dataclass(frozen=True)
class Registry:
    """Which analyzer serves which (field, language); ``fallback`` serves the rest.

    ``tables`` give the bodies of further languages their stop words and stems.
    """

    bound: dict[tuple[str, str], Analyzer] = field(
        default_factory=lambda: {("body", "en"): ENGLISH})
    fallback: Analyzer = STANDARD
    tables: Tables | None = None

    def resolved_langs(self, name: str) -> tuple[str, ...]:
        """Languages whose terms of field ``name`` are settled on the vocabulary."""
        ruled = [lang for (f, lang), a in self.bound.items() if f == name and a.stem]
        return (*ruled, *(self.tables.langs if self.tables is not None and name == "body" else ()))

    def resolves(self) -> bool:
        return any(self.resolved_langs(name) for name in FIELDS)

    def tokens(self, name: str, lang: Column, text: Column) -> Column:
        """Tokens of field ``name``, by the analyzer of the row's language."""
        return self._route(name, lang, text, "tokens")

    def spans(self, name: str, lang: Column, text: Column) -> Column:
        """Spans of field ``name``, by the analyzer of the row's language."""
        return self._route(name, lang, text, "spans")

    def _route(self, name: str, lang: Column, text: Column, form: str) -> Column:
        # Each analyzer sees null for rows of other languages, so none works in vain.
        known = {key[1]: a for key, a in self.bound.items() if key[0] == name}
        parts = [getattr(a, form)(F.when(lang == code, text)) for code, a in known.items()]
        rest = ~lang.isin(*known) if known else F.lit(True)
        parts.append(getattr(self.fallback, form)(F.when(rest, text)))
        return F.coalesce(*parts)


DEFAULT = Registry()
PLAIN = Registry(bound={("body", "en"): ENGLISH_STOP})


def field_tokens(docs: DataFrame, registry: Registry = DEFAULT, *carry: str,
                 names: tuple[str, ...] = FIELDS) -> DataFrame:
    """``(path, lang, *carry, field, tokens)``: one row per document and field, terms as cut."""
    lang = F.col("lang")
    both = F.array(*[
        F.struct(F.lit(name).alias("field"),
                 registry.tokens(name, lang, F.col(name)).alias("tokens"))
        for name in names])
    return docs.select("path", "lang", *carry, F.inline(both))


def explode_tokens(tokens: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, pos, term)`` from rows with a ``tokens`` array.

    Outer, then filtered: an inner explode adds a test of the array's size, which the
    optimizer moves below and which would tokenise every text twice.
    """
    rows = tokens.select(*keys, F.inline_outer("tokens")).filter("term is not null")
    return rows.select(*keys, "pos", "term")


def analyze_with_tables(tokens: DataFrame, stopwords: DataFrame, stems: DataFrame) -> DataFrame:
    """Drop stop words and replace stems by table, for languages with no built-in rules.

    ``tokens`` has ``lang`` and ``term``; ``stopwords(lang, term)``;
    ``stems(lang, term, stem)``. Both tables join on (lang, term); adaptive
    execution broadcasts a small one and splits frequent terms otherwise.
    """
    kept = tokens.join(stopwords.select("lang", "term"), ["lang", "term"], "left_anti")
    one = stems.groupBy("lang", "term").agg(F.min("stem").alias("stem"))
    joined = kept.join(one, ["lang", "term"], "left")
    return joined.withColumn("term", F.coalesce("stem", "term")).drop("stem")


def query_tokens(queries: DataFrame, registry: Registry = DEFAULT) -> DataFrame:
    """``(query_id, kind, lang, text, field, tokens)``: words of a query in each field, as cut."""
    both = F.array(*[
        F.struct(F.lit(name).alias("field"),
                 registry.tokens(name, F.col("lang"), F.col("text")).alias("tokens"))
        for name in FIELDS])
    return queries.select("query_id", "kind", "lang", "text", F.inline(both))


def single_term(terms: Column, text: Column) -> Column:
    """First analysed term, or the raw line lowercased when none is left."""
    return F.coalesce(F.try_element_at(terms, F.lit(1)), F.lower(text))
