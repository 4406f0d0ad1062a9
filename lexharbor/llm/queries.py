"""Registered queries of the training-data operators, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    cells,
    containment,
    langmix,
    mixing,
    neardup,
    pages,
    phrases,
    pii,
    runs,
    substrings,
    tokens,
    toxicity,
)
from .common import documents_of


def op1_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated_words(documents_of(spark, sf_dir)).drop("kept")


def op2_semi_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(documents_of(spark, sf_dir)).drop("text"))


def op3_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents_of(spark, sf_dir), width=2)


def op4_seekable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenised(spark, documents_of(spark, sf_dir))


def op6_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents_of(spark, sf_dir)).select("doc_id", "size", "source_size",
                                                          "target", "taken")


def op7_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(documents_of(spark, sf_dir, "pages"))


def op8_text_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(documents_of(spark, sf_dir), documents_of(spark, sf_dir, "labels"))


def op9_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.contained_items(documents_of(spark, sf_dir),
                                       documents_of(spark, sf_dir, "benchmark"))


def op5_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated_bytes(documents_of(spark, sf_dir)).drop("kept")


def op10_phrase_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.edited_fingerprints(documents_of(spark, sf_dir))


def op11_grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.quantize(documents_of(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.find_runs(runs.with_repeated_tails(documents_of(spark, sf_dir))))


def op13_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langmix.predict(documents_of(spark, sf_dir)).drop("languages")


QUERIES = {
    "op1_recompression": op1_recompression,
    "op2_semi_markov": op2_semi_markov,
    "op3_setsketch": op3_setsketch,
    "op4_seekable_tokens": op4_seekable_tokens,
    "op5_prefix_doubling": op5_prefix_doubling,
    "op6_water_filling": op6_water_filling,
    "op7_page_differencing": op7_page_differencing,
    "op8_text_cnn": op8_text_cnn,
    "op9_containment": op9_containment,
    "op10_phrase_fingerprint": op10_phrase_fingerprint,
    "op11_grid_cells": op11_grid_cells,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_language_mixture": op13_language_mixture,
}

ORACLE: dict[str, str] = {
    "op3_setsketch": neardup.SQL,
    "op6_water_filling": mixing.SQL,
    "op9_containment": containment.SQL,
    "op11_grid_cells": cells.sql(),
}
