"""Term completion from the term dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexharbor.operators.prefixes import RAW, match_prefixes

# Fixed value: completions per prefix.
COMPLETIONS = 30


def suggest_terms(vocabulary: DataFrame, asked: DataFrame, n: int = COMPLETIONS,
                  inside: bool = False) -> DataFrame:
    """``(prefix, term, df, rank)``: the ``n`` most frequent terms that start with each
    ``asked(prefix)``, or hold it anywhere if ``inside``.

    A term's tails stand for its inside: what begins one of them lies in the term. So both forms
    are the same equi-join, and no pattern is tried on every term.
    """
    terms, text = vocabulary.select("term", "df"), "term"
    if inside:
        starts = F.sequence(F.lit(1), F.length("term"))
        tails = F.transform(starts, lambda i: F.substring("term", i, F.length("term")))
        terms, text = terms.withColumn("tail", F.explode(F.array_distinct(tails))), "tail"
    best = Window.partitionBy("prefix").orderBy(F.desc("df"), "term")
    found = match_prefixes(terms, asked.select("prefix").distinct(), RAW, text=text)
    return (found.select("prefix", "term", "df").distinct()
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n))
