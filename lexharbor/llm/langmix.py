"""Languages of a document as a mixture, fitted by expectation-maximisation.

A text's letter trigrams are taken as draws from a mixture of the learned languages. The shares are
those of greatest likelihood, found by expectation-maximisation over the text's trigrams with their
counts. Which languages belong to the text is then settled by a penalised likelihood: a language
stays only if leaving it out costs more than half the logarithm of the number of trigrams.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .runs import slices

GRAM = 3
# Bound of the table of likelihoods, in bytes: the more languages, the fewer hash buckets.
TABLE_BYTES = 64 << 20
MOST_BUCKETS = 1 << 17
# Share of a language's likelihood that comes from all languages together, so none is zero.
COMMON = 0.02
# Trigrams added to a text's shares, dealt evenly: short texts keep some doubt.
PRIOR = 1.0
STEPS, SETTLED = 25, 1e-3
PENALTY = 0.5
# Text counted at once, and cells (trigram, language) held at once when texts are judged.
SLICE_BYTES = 1 << 20
CELLS = 1 << 20
UNDETERMINED = "und"
# Which code points are letters.
LETTER = np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
HELD_OUT = 2


@dataclass
class Model:
    """Learned languages in order of name, and each trigram bucket's likelihood in them."""

    langs: list[str]
    likelihood: np.ndarray


def gram_buckets(texts: list[str | None], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram of the texts, and the text it belongs to.

    Texts are lower-cased, with one space before, between and after their words of letters, so
    a text has a trigram if and only if it has a letter.
    """
    padded = [f" {(t or '').lower()} " for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in padded])
    letters = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = LETTER[letters]
    kept = letter.copy()
    kept[1:] |= letter[:-1] | (owner[1:] != owner[:-1])
    kept[:1] = True
    mixed, owner = np.where(letter, letters, 32)[kept].astype(np.uint64), owner[kept]
    if len(mixed) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = mixed[:-2] * MIX[0] + mixed[1:-1] * MIX[1] + mixed[2:] * MIX[2]
    mixed ^= mixed >> np.uint64(32)
    mixed *= MIX[1]
    inside = owner[:-2] == owner[2:]
    found = (mixed >> np.uint64(40)).astype(np.int64) % buckets
    return found[inside], owner[:-2][inside]


def held_out(doc_id) -> object:
    """Rows kept from learning, by id; a null id is learned from."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")
    return F.crc32(name) % 4 == HELD_OUT


def _counting(langs: list[str], buckets: int):
    at = {lang: i for i, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), buckets), dtype=np.int64)
        for batch in batches:
            for piece in slices(batch, SLICE_BYTES):
                rows = [(at[lang], text) for lang, text in
                        zip(piece.column("lang").to_pylist(), piece.column("text").to_pylist(),
                            strict=True) if lang in at]
                owner = np.array([lang for lang, _ in rows], dtype=np.int64)
                bucket, text = gram_buckets([text for _, text in rows], buckets)
                total += np.bincount(owner[text] * buckets + bucket,
                                     minlength=total.size).reshape(total.shape)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array(lang, pa.int32()), "bucket": pa.array(bucket, pa.int32()),
            "n": pa.array(total[lang, bucket], pa.int64())})
    return run


def train(labelled: DataFrame, table_bytes: int = TABLE_BYTES) -> Model:
    """Learn from all rows of ``labelled(text, lang)`` with both values.

    Tasks count trigrams by language, Spark adds them up; the driver holds one number per language
    and bucket, ``table_bytes`` at most, so at most ``table_bytes // 64`` languages are learned, the
    commonest ones. Without such rows the model knows no language.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select("text", "lang").filter("text is not null and lang is not null")
    names = (rows.groupBy("lang").count().orderBy(F.desc("count"), "lang")
             .limit(table_bytes // 64).collect())
    langs = sorted(r["lang"] for r in names)
    if not langs:
        return Model([], np.zeros((MOST_BUCKETS, 0)))
    buckets = MOST_BUCKETS
    while buckets > 16 and buckets * len(langs) * 4 > table_bytes:
        buckets //= 2
    counted = (rows.mapInArrow(_counting(langs, buckets), "lang int, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    n = np.zeros((buckets, len(langs)))
    n[counted["bucket"].to_numpy(), counted["lang"].to_numpy()] = counted["n"].to_numpy()
    common = (n.sum(axis=1) + 1) / (n.sum() + buckets)
    share = n / np.maximum(n.sum(axis=0), 1)
    return Model(langs, ((1 - COMMON) * share + COMMON * common[:, None]).astype(np.float32))


def _shares(found: np.ndarray, count: np.ndarray, starts: np.ndarray, allowed: np.ndarray):
    """Shares of the allowed languages in each text, and the mixture's log likelihood.

    ``found`` has a row of likelihoods for each distinct trigram of a text, ``count`` how often
    it occurs, ``starts`` where each text's rows begin.
    """
    texts, langs = allowed.shape
    owner = np.repeat(np.arange(texts), np.diff(np.r_[starts, len(count)]))
    size = np.add.reduceat(count, starts)
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    log_of = np.zeros(texts)
    going = np.arange(texts)
    rows, mine, own = found, count, owner
    for step in range(STEPS):
        weighed = rows * shares[own]
        whole = weighed.sum(axis=1)
        at = np.searchsorted(own, going)
        log_of[going] = np.add.reduceat(mine * np.log(whole), at)
        drawn = np.add.reduceat(weighed * (mine / whole)[:, None], at, axis=0)
        prior = allowed[going] * (PRIOR / allowed[going].sum(axis=1, keepdims=True))
        new = (drawn + prior) / (size[going] + PRIOR)[:, None]
        moving = np.abs(new - shares[going]).max(axis=1) > SETTLED
        shares[going] = new
        if not moving.any() or step == STEPS - 1:
            break
        if moving.mean() < 0.7:
            going = going[moving]
            stay = np.isin(own, going)
            rows, mine, own = rows[stay], mine[stay], own[stay]
    return shares, log_of


def language_sets(found: np.ndarray, count: np.ndarray, starts: np.ndarray):
    """Which languages each text is in, their shares, and the shares among all languages.

    From all languages, the one with the least share leaves as long as the penalised likelihood
    does not fall. A text that one language explains as well as all of them is settled at once.
    """
    texts, langs = len(starts), found.shape[1]
    size = np.add.reduceat(count, starts)
    price = PENALTY * np.log(size + 1)
    allowed = np.ones((texts, langs))
    every, best = _shares(found, count, starts, allowed)
    alone = np.add.reduceat(np.log(found) * count[:, None], starts, axis=0)
    top = alone.argmax(axis=1)
    # the likelihood of any larger set is no more than that of all languages
    single = best - alone[np.arange(texts), top] <= price
    chosen, shares = allowed.copy(), every.copy()
    chosen[single] = shares[single] = np.eye(langs)[top[single]]
    going = np.flatnonzero(~single)
    bounds = np.r_[starts, len(count)]
    while len(going):
        least = np.where(chosen[going] > 0, shares[going], np.inf).argmin(axis=1)
        fewer = chosen[going].copy()
        fewer[np.arange(len(going)), least] = 0
        pick = np.concatenate([np.arange(bounds[t], bounds[t + 1]) for t in going])
        sizes = (bounds[1:] - bounds[:-1])[going]
        tried, log_of = _shares(found[pick], count[pick], np.cumsum(sizes) - sizes, fewer)
        better = best[going] - log_of <= price[going]
        going = going[better]
        chosen[going], shares[going], best[going] = fewer[better], tried[better], log_of[better]
        going = going[chosen[going].sum(axis=1) > 1]
    return chosen > 0, shares, every


def mixtures(texts: list[str | None], model: Model) -> list[tuple[list[tuple[str, float]], float]]:
    """For each text its languages with their shares, greatest first, and the first one's score."""
    out: list[tuple[list[tuple[str, float]], float]] = [([], 0.0)] * len(texts)
    buckets, start = len(model.likelihood), 0
    most = max(1, CELLS // max(len(model.langs), 1))
    while start < len(texts) and model.langs:
        stop, held = start, 0
        while stop < len(texts) and (stop == start or held + len(texts[stop] or "") <= most):
            held += len(texts[stop] or "")
            stop += 1
        bucket, owner = gram_buckets(texts[start:stop], buckets)
        keys, count = np.unique(owner * buckets + bucket, return_counts=True)
        live, starts = np.unique(keys // buckets, return_index=True)
        if len(live):
            kept, shares, every = language_sets(model.likelihood[keys % buckets].astype(float),
                                                count.astype(float), starts)
        for k, i in enumerate(live.tolist()):
            order = np.argsort(-shares[k], kind="stable")
            found = [(model.langs[j], float(shares[k, j])) for j in order if kept[k, j]]
            out[start + i] = found, float(min(1.0, every[k, order[0]]))
        start = stop
    return out


MIXED = "doc_id long, held_out boolean, languages array<struct<lang: string, share: double>>, score double"


def infer(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, languages, score`` for every row of ``docs(doc_id, text)``.

    ``languages(lang, share)`` come greatest share first, none for a text that is null or has no
    letter, or if the model knows none; ``score`` is the first one's share among all languages,
    0 without one. Equal shares go by name of the language. Null and repeated ids keep their rows;
    an empty table gives none; only ``doc_id`` and ``text`` are read.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, SLICE_BYTES):
                found = mixtures(piece.column("text").to_pylist(), model)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": piece.column("doc_id"), "held_out": piece.column("held_out"),
                    "languages": pa.array([[{"lang": a, "share": s} for a, s in f] for f, _ in found],
                                          pa.list_(pa.struct([("lang", pa.string()),
                                                              ("share", pa.float64())]))),
                    "score": pa.array([s for _, s in found], pa.float64())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       held_out("doc_id").alias("held_out"), "text")
    return rows.mapInArrow(run, MIXED)


def predict(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, languages`` learned from the rows not held out.

    ``docs(doc_id, text, lang)``; ``lang`` is read for learning alone. ``lang_pred`` is the language
    with the greatest share, ``und`` if there is none.
    """
    model = train(docs.filter(~held_out("doc_id")))
    found = infer(docs, model)
    return found.select("doc_id", "held_out", F.coalesce(
        F.get("languages", F.lit(0))["lang"], F.lit(UNDETERMINED)).alias("lang_pred"),
        "score", "languages")
