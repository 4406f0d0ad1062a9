"""Snippets: cut bodies into fragments, score them by query terms, mark and merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexharbor.functions.cutting import cut_words
from lexharbor.functions.text import one_line
from lexharbor.operators.analysis import DEFAULT, Registry

# Fixed value: fragments per hit.
BEST = 10


def cut_bodies(docs: DataFrame, registry: Registry = DEFAULT,
               keys: tuple[str, ...] = ("path",), blocked: DataFrame | None = None) -> DataFrame:
    """``(*keys, lang, size, words)``: kept words of each body with offsets and fragment numbers.

    Done within each document row, without a shuffle. ``blocked(*keys, pos)`` lists
    places inside a phrase match, where no fragment may start.
    """
    if blocked is None:
        walls = docs.withColumn("blocked", F.array().cast("array<int>"))
    else:
        places = blocked.groupBy(*keys).agg(F.collect_set("pos").alias("blocked"))
        walls = docs.join(places, [*keys], "left").withColumn(
            "blocked", F.coalesce("blocked", F.array().cast("array<int>")))
    spans = registry.spans("body", F.col("lang"), F.col("body"))
    return walls.select(*keys, "lang", F.length("body").alias("size"),
                        cut_words(spans, F.col("blocked")).alias("words"))


def words_of_cut(cut: DataFrame, keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """``(*keys, pos, term, start, end, frag_no)``, one row per kept word."""
    # outer, then filtered: an inner one adds a size test that would cut the text twice
    return cut.select(*keys, F.inline_outer("words")).filter("term is not null")


def fragments(cut: DataFrame, keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """``(*keys, frag_no, start, end)``: each fragment runs from the last word of the one
    before to its own last word, the final one to the end of the text."""
    last = F.size("words") - 1
    places = F.when(last >= 0, F.sequence(F.lit(0), last))
    ends = cut.withColumn("lasts", F.filter(
        places,
        lambda i: (i == last) | (F.get("words", i)["frag_no"] != F.get("words", i + 1)["frag_no"])))
    rows = F.transform("lasts", lambda i, n: F.struct(
        F.get("words", i)["frag_no"].alias("frag_no"),
        F.when(n == 0, F.lit(0)).otherwise(
            F.get("words", F.get("lasts", n - 1))["end"]).alias("start"),
        F.when(i == last, F.col("size")).otherwise(F.get("words", i)["end"]).alias("end")))
    return ends.select(*keys, F.inline(rows))


def fragment_scores(tokens: DataFrame, wanted: DataFrame,
                    keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """``(query_id, path, frag_no, score, marks)`` of fragments holding a wanted term.

    ``wanted(query_id, path, term, weight)`` lists the terms of each hit, whatever field
    they came from (and ``pos``, where only certain places count). The score adds the
    weight of each distinct term once; ``marks`` lists the places of all of them.
    """
    on = [*keys, "term"] + (["pos"] if "pos" in wanted.columns else [])
    found = tokens.join(wanted, on)
    per_term = (found.groupBy("query_id", "path", "frag_no", "term")
                .agg(F.max("weight").alias("weight"),
                     F.collect_list(F.struct("start", "end")).alias("marks")))
    return (per_term.groupBy("query_id", "path", "frag_no")
            .agg(F.sum("weight").alias("score"),
                 F.sort_array(F.flatten(F.collect_list("marks"))).alias("marks"))
            .filter("score > 0"))


def best_fragments(scores: DataFrame, n: int = BEST) -> DataFrame:
    """The ``n`` best fragments of each hit, equal scores by place in the text."""
    best = Window.partitionBy("query_id", "path").orderBy(F.desc("score"), "frag_no")
    return scores.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= n)


def merged(best: DataFrame, cuts: DataFrame, keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """``(query_id, path, frag_no, n_frags, score, start, end, marks)``: neighbouring
    winners put together; ``frag_no`` is the first of the run, ``score`` its best."""
    order = Window.partitionBy("query_id", "path").orderBy("frag_no")
    runs = (best.join(cuts, [*keys, "frag_no"])
            .withColumn("run", F.col("frag_no") - F.row_number().over(order)))
    return (runs.groupBy("query_id", "path", "run")
            .agg(F.min("frag_no").alias("frag_no"), F.count(F.lit(1)).alias("n_frags"),
                 F.max("score").alias("score"), F.min("start").alias("start"),
                 F.max("end").alias("end"),
                 F.sort_array(F.flatten(F.collect_list("marks"))).alias("marks"))
            .drop("run"))


def marked_text(body: Column, start: Column, end: Column, marks: Column,
                pre: str = "<b>", post: str = "</b>") -> Column:
    """The fragment ``[start, end)`` of ``body`` on one line, tags around ``marks``."""
    def cut(a: Column, b: Column) -> Column:
        return F.substring(body, a + 1, b - a)

    begin = F.struct(start.alias("at"), F.lit("").alias("out"))
    text = F.aggregate(
        marks, begin,
        lambda acc, m: F.struct(
            m["end"].alias("at"),
            F.concat(acc["out"], cut(acc["at"], m["start"]), F.lit(pre),
                     cut(m["start"], m["end"]), F.lit(post)).alias("out")),
        lambda acc: F.concat(acc["out"], cut(acc["at"], end)))
    return one_line(text)


def phrase_places(phrase_hits: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(query_id, path, term, pos, weight)``: the places a phrase match covers."""
    terms = phrases.select("query_id", "field", F.inline("tokens")).withColumnRenamed(
        "pos", "place")
    hits = phrase_hits.select("query_id", "path", "field", F.explode("starts").alias("at"))
    return (hits.join(terms, ["query_id", "field"])
            .select("query_id", "path", "term", (F.col("at") + F.col("place")).alias("pos"),
                    F.lit(1.0).alias("weight"), "place").distinct())
