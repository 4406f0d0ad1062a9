"""Language detection from labelled documents, and routing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lexharbor.session import BROADCAST_ROWS, broadcast_within, count_up_to, materialize

# Share of an unseen gram, least lead per gram (in thousandths of a nat) for a
# verdict to be certain.
UNSEEN_SHARE, MARGIN = 0.00001, 100
# Characters of a gram.
GRAM = 3
# Characters counted at once: the arrays of a task hold about a hundred bytes for each.
PIECE_CHARS = 1 << 18


def letters_of(text: Column) -> Column:
    """The lowercased text, all but letters made one blank, with a blank at either end."""
    letters = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))
    return F.concat(F.lit(" "), letters, F.lit(" "))


def _pieces(letters: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Where each run of texts of about ``PIECE_CHARS`` characters starts, and the run."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(letters), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(letters):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PIECE_CHARS, "right")))
        yield start, letters.slice(start, stop - start)
        start = stop


def _counted(letters: pa.Array) -> pa.ListArray:
    texts = letters.to_pylist()
    points = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t or "") for t in texts], np.int64)
    runs = np.maximum(sizes - GRAM + 1, 0)
    doc = np.repeat(np.arange(len(texts)), runs)
    at = np.arange(len(doc)) + np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(runs) - runs), runs)
    code = np.zeros(len(doc), np.int64)
    for k in range(GRAM):  # a character is below 2 ** 21, so three make one number
        code = code << 21 | points[at + k].astype(np.int64)
    known, place = np.unique(code, return_inverse=True)
    pairs, n = np.unique(doc * max(len(known), 1) + place, return_counts=True)
    doc, place = np.divmod(pairs, max(len(known), 1))
    signs = np.stack([known >> 21 * k & 0x1FFFFF for k in range(GRAM - 1, -1, -1)], 1)
    whole = signs.astype("<u4").tobytes().decode("utf-32-le")
    names = pa.array([whole[i:i + GRAM] for i in range(0, len(whole), GRAM)], pa.string())
    found = pa.StructArray.from_arrays(
        [names.take(pa.array(place)), pa.array(n, pa.int64()), pa.array(runs[doc], pa.int32())],
        names=["gram", "n", "n_grams"])
    stops = np.cumsum(np.bincount(doc, minlength=len(texts)))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int32()), found)


@F.arrow_udf(T.ArrayType(T.StructType([
    T.StructField("gram", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField("n_grams", T.IntegerType())])))
def counted_grams(letters: pa.Array) -> pa.Array:
    """All different runs of ``GRAM`` characters of each text, how often each occurs in it, and how
    many runs the text has in all."""
    return pa.concat_arrays([_counted(piece) for _, piece in _pieces(letters)] or [_counted(letters)])


def gram_rows(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, gram, n, n_grams)``: the :func:`counted_grams` of each text, a row for each.

    Python holds the grams of a piece of a batch at a time, not those of all its texts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, piece in _pieces(b.column(1)):
                lists = _counted(piece)
                whose = pc.add(pc.list_parent_indices(lists), start)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(whose), *lists.flatten().flatten()], names)

    source = rows.select(key, letters_of(F.col(text)).alias("letters"))
    schema = T.StructType([
        source.schema[0], T.StructField("gram", T.StringType()), T.StructField("n", T.LongType()),
        T.StructField("n_grams", T.IntegerType())])
    names = schema.names
    return source.mapInArrow(run, schema)


def train(labelled: DataFrame, keep: int | None = None) -> DataFrame:
    """``(lang, gram, weight)`` from ``(lang, text)``: the grams of each language.

    A weight is how far the log share of a gram exceeds that of an unseen one, as a
    whole number of thousandths, so sums do not depend on their order. All grams are
    kept; ``keep`` asks for a smaller model of that many commonest grams per language.
    """
    counts = gram_rows(labelled, "lang", "text").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # read again for the totals and by whoever asks the model: texts are cut once
    counts = materialize(counts, "grams")
    kept = counts
    if keep is not None:
        commonest = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
        kept = (counts.withColumn("place", F.row_number().over(commonest))
                .filter(F.col("place") <= keep))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = F.col("n").cast("double") / F.col("total").cast("double")
    return kept.join(totals, "lang").select(
        "lang", "gram", F.round(F.lit(1000.0) * F.log(share / F.lit(UNSEEN_SHARE)))
        .cast("long").alias("weight")).filter("weight > 0")


def detect(docs: DataFrame, profile: DataFrame, key: str = "path", text: str = "body",
           margin: int = MARGIN) -> DataFrame:
    """``(key, detected, score, runner_up, n_grams, certain)`` for every document.

    Each different gram of a text is one row with its count; it meets one row of the model, which
    holds the weights of all languages, by broadcast if a count shows the model small. Partial sums
    leave one row per document before the next shuffle. Certain means the best language leads the
    next by ``margin`` per gram. Documents without a known gram have no language.
    """
    cut = gram_rows(docs, key, text)
    profile = materialize(profile, "profile")
    # a model has few languages, however many documents it comes from
    langs = sorted(r["lang"] for r in profile.select("lang").distinct().collect())
    model = profile.groupBy("gram").agg(*[
        F.sum(F.when(F.col("lang") == lang, F.col("weight"))).alias(f"w{i}")
        for i, lang in enumerate(langs)] or [F.lit(None).alias("w")])
    rows = count_up_to(model, BROADCAST_ROWS)
    sums = cut.join(broadcast_within(model, rows), "gram").groupBy(key, "n_grams").agg(
        *[F.sum(F.col(f"w{i}") * F.col("n")).alias(f"s{i}") for i in range(len(langs))])
    scores = [F.when(F.col(f"s{i}").isNotNull(), F.struct(
        (-F.col(f"s{i}")).alias("minus"), F.lit(lang).alias("lang"))) for i, lang in enumerate(langs)]
    none = F.array().cast("array<struct<minus: bigint, lang: string>>")
    ranked = sums.select(key, "n_grams", F.sort_array(
        F.array_compact(F.array(*scores)) if scores else none).alias("best"))
    first, second = F.get("best", F.lit(0)), F.try_element_at("best", F.lit(2))
    lead = (-first["minus"]) - F.coalesce(-second["minus"], F.lit(0))
    verdicts = ranked.select(
        key, first["lang"].alias("detected"), (-first["minus"]).alias("score"),
        second["lang"].alias("runner_up"), "n_grams",
        (lead >= F.lit(margin) * F.col("n_grams")).alias("certain"))
    return (docs.select(key).join(verdicts, key, "left")
            .withColumn("certain", F.coalesce("certain", F.lit(False))))


def route(certain: Column, detected: Column, alt: str = "pl", default: str = "en") -> Column:
    """``alt`` only for documents certainly in it; everything else is ``default``."""
    return F.when(certain & (detected == alt), F.lit(alt)).otherwise(F.lit(default))
