"""Term, phrase, fuzzy and path-prefix lookups with scores.

Every lookup joins a table of analysed queries to the postings on
(lang, field, term). The query side is broadcast only when a count shows it small;
beyond that the join shuffles and adaptive execution splits frequent terms.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexharbor.functions.edits import MOST_KEYS, deletion_keys, swap_distance
from lexharbor.operators.prefixes import RAW, match_prefixes
from lexharbor.session import (
    BROADCAST_ROWS, broadcast_within, count_up_to, least_level, materialize)

KEY = ["lang", "field", "term"]

# Ranking and expansion parameters.
K1, B = 1.2, 0.75
MAX_EDITS, MAX_EXPANSIONS = 2, 50
# Tasks that take what one task reads of the postings of fuzzy words.
TASKS_PER_SCAN = 8


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))


def bm25(weight: Column, tf: Column, length: Column, avg_len: Column) -> Column:
    norm = F.lit(K1) * (F.lit(1.0 - B) + F.lit(B) * length / avg_len)
    return weight * tf / (tf + norm)


def exact_sum(value: Column) -> Column:
    """Sum in steps of 2**-40: whole numbers, so no order of adding changes a rank."""
    step = float(2 ** 40)
    return F.sum(F.floor(value * F.lit(step))) / F.lit(step)


def with_stats(index, qterms: DataFrame):
    """Query terms with ``df, n_docs, avg_len``, and the :class:`Reach` of the terms asked.

    Terms that occur nowhere drop out.
    """
    reach = index.reach(qterms)
    wanted = broadcast_within(qterms.select(*KEY).distinct(), reach.rows)
    dfs = index.term_stats_of(wanted, reach).select(*KEY, "df")
    known = (qterms.join(broadcast_within(dfs, reach.rows), KEY)
             .join(index.field_stats().select("lang", "field", "n_docs", "avg_len"),
                   ["lang", "field"]))
    return known, reach


def term_hits(index, qterms: DataFrame) -> DataFrame:
    """``(query_id, path, field, term, score)`` for single-term clauses."""
    known, reach = with_stats(index, qterms)
    weighed = known.withColumn("weight", idf(F.col("n_docs"), F.col("df")))
    return _score_terms(index, weighed, reach)


def _score_terms(index, weighed: DataFrame, reach) -> DataFrame:
    side = weighed.select("query_id", *KEY, "weight", "avg_len")
    joined = index.postings_within(reach).join(broadcast_within(side, reach.rows), KEY)
    length = index.norm(F.col("len"))
    return joined.select(
        "query_id", "path", "field", "term",
        bm25(F.col("weight"), F.col("tf"), length, F.col("avg_len")).alias("score"))


def phrase_rows(index, phrases: DataFrame) -> DataFrame:
    """``(query_id, path, field, n, weight, avg_len, len, starts)``: a row for each term of a phrase
    and document that may hold it; ``starts`` are the places where the phrase would begin.

    The rarest term of each phrase comes first: its documents are the candidates, stored once.
    Each candidate asks for the other terms of its phrase in its own document, and a posting is
    joined with what was asked of it by term and document. So each posting of a term asked for
    is read once, however many phrases hold the term, and no more rows are made than candidates
    times the length of their phrase.
    Phrases with a term found nowhere drop out at once.
    """
    qterms = (phrases.select("query_id", "lang", "field", F.size("tokens").alias("n"),
                             F.inline("tokens"))
              .withColumnRenamed("pos", "place"))
    known, reach = with_stats(index, qterms)
    phrase = Window.partitionBy("query_id", "lang", "field")
    side = materialize(
        known.withColumn("found", F.count(F.lit(1)).over(phrase)).filter("found = n")
        .withColumn("turn", F.row_number().over(phrase.orderBy("df", "place")))
        .select("query_id", *KEY, "n", "place", "turn", "avg_len",
                idf(F.col("n_docs"), F.col("df")).alias("weight")), "phrase_terms")
    keys = ["query_id", "path", "field"]

    def rows_of(joined: DataFrame) -> DataFrame:
        return joined.select(*keys, "n", "weight", "avg_len", "len",
                             F.expr("transform(positions, p -> p - place)").alias("starts"))

    first, others = side.filter("turn = 1"), side.filter("turn > 1")
    rarest = materialize(rows_of(index.postings_within(reach).join(
        broadcast_within(first, reach.rows), KEY)), "candidates")
    wanted = rarest.filter("n > 1").select(*keys).distinct()
    asked = materialize(others.drop("turn").join(
        broadcast_within(wanted, count_up_to(wanted, BROADCAST_ROWS)), ["query_id", "field"]), "asked")
    terms = broadcast_within(others.select(*KEY).distinct(), reach.rows)
    rest = index.postings_within(reach).join(terms, KEY, "left_semi").join(
        broadcast_within(asked, count_up_to(asked, BROADCAST_ROWS)), [*KEY, "path"])
    return rarest.unionByName(rows_of(rest))


def phrase_hits(index, phrases: DataFrame) -> DataFrame:
    """``(query_id, path, field, freq, starts, n_terms, score)`` of exact phrases.

    ``phrases(query_id, lang, field, tokens)`` holds analysed tokens whose ``pos`` is
    the place each term must take. A term's positions are shifted back by its place
    and the shifted lists of one document intersected, so rows shuffle per posting,
    not per position, keyed by (query, document).
    """
    per_doc = (phrase_rows(index, phrases).groupBy("query_id", "path", "field")
               .agg(F.count(F.lit(1)).alias("found"), F.first("n").alias("n_terms"),
                    exact_sum(F.col("weight")).alias("weight"), F.first("avg_len").alias("avg_len"),
                    F.first("len").alias("len"), F.collect_list("starts").alias("lists"))
               .filter("found = n_terms"))
    common = F.aggregate(F.slice("lists", 2, F.size("lists")), F.col("lists")[0],
                         lambda acc, x: F.array_intersect(acc, x))
    matched = (per_doc.withColumn("starts", common).withColumn("freq", F.size("starts"))
               .filter("freq > 0"))
    return matched.select(
        "query_id", "path", "field", "freq", "starts", "n_terms",
        bm25(F.col("weight"), F.col("freq"), index.norm(F.col("len")),
             F.col("avg_len")).alias("score"))


def fuzzy_candidates(vocabulary: DataFrame, words: DataFrame) -> DataFrame:
    """``(lang, field, word, term, df)`` that may lie within two edits.

    ``words(lang, field, word)`` are distinct. Both sides emit deletion keys and join
    on them, which finds every pair within two edits. A word gives its keys with every
    length in reach, so terms with a common beginning are split by length. A threshold on the
    built-in distance then drops most others before the pairs are made distinct.
    """
    rows = count_up_to(words, BROADCAST_ROWS)
    reach = F.sequence(F.length("word") - MAX_EDITS, F.length("word") + MAX_EDITS)
    keys = (words.withColumn("key", F.explode(deletion_keys(F.col("word")))).filter("key is not null")
            .select("*", F.explode(reach).alias("size")))
    terms = (vocabulary.select("lang", "field", "term", "df", F.length("term").alias("size"))
             .withColumn("key", F.explode(deletion_keys(F.col("term")))).filter("key is not null"))
    bound = rows * MOST_KEYS * (2 * MAX_EDITS + 1)
    near = (terms.join(broadcast_within(keys, bound, 4 * BROADCAST_ROWS),
                       ["lang", "field", "size", "key"])
            .filter(F.levenshtein("term", "word", 2 * MAX_EDITS) >= 0))
    return near.select("lang", "field", "word", "term", "df").distinct()


def fuzzy_expand(vocabulary: DataFrame, words: DataFrame, n: int = MAX_EXPANSIONS) -> DataFrame:
    """``(lang, field, word, term, df, edits, boost, rank, top_df)``.

    The ``n`` best expansions of each word by boost, then term; ``top_df`` is the largest
    document frequency among them, which scoring uses for all.
    """
    least = F.least(F.length("word"), F.length("term"))
    scored = (fuzzy_candidates(vocabulary, words)
              .withColumn("edits", swap_distance("word", "term"))
              .filter((F.col("edits") <= MAX_EDITS) & (F.col("edits") < least))
              .withColumn("boost", F.lit(1.0) - F.col("edits") / least))
    per_word = Window.partitionBy("lang", "field", "word")
    best = per_word.orderBy(F.desc("boost"), "term")
    return (scored.withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= n)
            .withColumn("top_df", F.max("df").over(per_word)))


def levenshtein_expand(vocabulary: DataFrame, words: DataFrame) -> DataFrame:
    """``(lang, field, word, term, edits)`` within two edits, a swap counting as two."""
    return (fuzzy_candidates(vocabulary, words)
            .withColumn("edits", F.levenshtein("word", "term"))
            .filter((F.col("edits") <= MAX_EDITS)
                    & (F.col("edits") < F.least(F.length("word"), F.length("term"))))
            .select("lang", "field", "word", "term", "edits"))


def fuzzy_hits(index, qterms: DataFrame, n: int = MAX_EXPANSIONS) -> DataFrame:
    """``(query_id, path, field, term, score, boost)`` over the ``n`` best expansions of each word."""
    words = qterms.select("lang", "field", F.col("term").alias("word")).distinct()
    expansions = index.expansions(words, n)
    weighed = (expansions.join(index.field_stats().select("lang", "field", "n_docs", "avg_len"),
                               ["lang", "field"])
               .withColumn("weight", F.col("boost") * idf(F.col("n_docs"), F.col("top_df")))
               .select("lang", "field", "word", "term", "boost", "weight", "avg_len"))
    # read twice: to see how far the terms reach, and to join
    asked = materialize(weighed.join(qterms.select(
        "query_id", "lang", "field", F.col("term").alias("word")), ["lang", "field", "word"])
        .drop("word"), "expansions")
    reach = index.reach(asked)
    rows = index.postings_within(reach).select(*KEY, "path", "tf", "len")
    if reach.rows <= BROADCAST_ROWS:
        # A term is near many words: its postings are dealt by document before they multiply, and
        # the hits of a document then add up where they are, in tasks that keep their size.
        wide = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                   TASKS_PER_SCAN * rows.rdd.getNumPartitions())
        rows = rows.join(F.broadcast(asked.select(*KEY).distinct()), KEY, "left_semi").repartition(
            wide, "path")
    joined = rows.join(broadcast_within(asked, reach.rows), KEY)
    return joined.select(
        "query_id", "path", "field", "term",
        bm25(F.col("weight"), F.col("tf"), index.norm(F.col("len")),
             F.col("avg_len")).alias("score"), "boost")


def prefix_hits(paths: DataFrame, queries: DataFrame) -> DataFrame:
    """``(query_id, path, score)``: raw, case-sensitive path prefixes, score 1."""
    asked = queries.select("query_id", F.col("text").alias("prefix"))
    return (match_prefixes(paths.select("path"), asked, RAW)
            .select("query_id", "path", F.lit(1.0).alias("score")))


def either_clause(*clauses: DataFrame, apart: bool = False) -> DataFrame:
    """``(query_id, path, score)``: a document matching any clause, scores added.

    ``apart`` says that no query has hits in two of the clauses: the hits of each then add up
    alone, where its documents lie, and are not shuffled together.
    """
    rows = [c.select("query_id", "path", "score") for c in clauses]
    if apart:
        rows = [_added(r) for r in rows]
    every = reduce(DataFrame.unionByName, rows)
    return every if apart else _added(every)


def _added(hits: DataFrame) -> DataFrame:
    return hits.groupBy("query_id", "path").agg(exact_sum(F.col("score")).alias("score"))


def with_df(postings: DataFrame, stats: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``postings`` joined with ``stats(lang, field, term, df, …)`` of all their terms.

    The statistics of up to ``limit`` of the commonest terms are broadcast, so nearly all postings
    stay where they are; those of rarer terms alone are shuffled.
    """
    stats = materialize(stats, "stats")
    if count_up_to(stats, limit) <= limit:
        return postings.join(F.broadcast(stats), KEY)
    least = least_level(stats, "df", limit)
    if least is None:
        return postings.join(stats, KEY)
    common = F.broadcast(stats.filter(F.col("df") >= least))
    rare = postings.join(F.broadcast(common.select(*KEY)), KEY, "left_anti")
    return postings.join(common, KEY).unionByName(rare.join(stats.filter(F.col("df") < least), KEY))
