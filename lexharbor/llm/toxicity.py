"""Toxicity by a convolutional text classifier, trained in numpy."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SIGNS, Words, id_and_text, small_batches

BUCKETS = 1 << 16
SIZE = 12
WIDTHS = (1, 2, 3)
FILTERS = 12
# A word is the sum of the vectors of its whole and of its first bytes.
HEADS = (5, 7)
# Bounds of the sample the classifier is fitted on: rows, and bytes of a text.
SAMPLE_ROWS, SAMPLE_BYTES = 12000, 16 << 10
EPOCHS, BATCH, RATE = 10, 64, 0.05
THRESHOLD = 0.3
# Pseudo-documents behind a bucket's log-odds at the start, and labels a language needs for
# a threshold of its own.
PRIOR, OWN_THRESHOLD = 4.0, 40


def features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket ids (positions x kinds), first position of each text, positions of each text.

    Each text is followed by empty positions, as many as the widest filter reaches over its end.
    """
    words = Words(pc.utf8_lower(column), gaps=SIGNS)
    kinds = [words.names] + [words.heads(k) for k in HEADS]
    pad = max(WIDTHS) - 1
    size = np.maximum(words.counts, 1) + pad
    first = np.cumsum(size) - size
    out = np.full((int(size.sum()) + pad, len(kinds)), BUCKETS, dtype=np.int32)
    at = np.arange(len(words.names)) + np.repeat(
        first - (np.cumsum(words.counts) - words.counts), words.counts)
    for k, names in enumerate(kinds):
        out[at, k] = ((names ^ np.uint64(k * 0x9E37)) >> np.uint64(20)) % np.uint64(BUCKETS)
    return out, first, np.maximum(words.counts, 1)


@dataclass
class Model:
    """Weights, the calibration of the score and the thresholds by language."""

    table: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    shift: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        out = self.table[ids[:, 0]]
        for k in range(1, ids.shape[1]):
            out = out + self.table[ids[:, k]]
        return out

    def pooled(self, ids, first, size, where: bool = False):
        """Largest answer of each filter in each text and, if asked, its position."""
        x = self.vectors(ids)
        n = len(ids) - max(WIDTHS) + 1
        bounds = np.empty(2 * len(first), dtype=np.int64)
        bounds[0::2], bounds[1::2] = first, first + size
        bounds[-1] = min(bounds[-1], n)
        values, places = [], []
        for w, (f, b) in enumerate(zip(self.filters, self.bias, strict=True)):
            width = WIDTHS[w]
            y = x[:n] @ f[0]
            for k in range(1, width):
                y += x[k:n + k] @ f[k]
            y = np.concatenate([y, np.full((1, y.shape[1]), -np.inf, y.dtype)])
            top = np.maximum.reduceat(y, bounds, axis=0)[0::2]
            values.append(np.maximum(top + b, 0))
            if where:
                row = np.repeat(np.arange(len(first)), size)
                at = np.concatenate([np.arange(a, a + s) for a, s in zip(first, size, strict=True)])
                hit = y[at] == top[row]
                place = np.where(hit, at[:, None], n)
                starts = np.cumsum(size) - size
                places.append(np.minimum.reduceat(place, starts, axis=0))
        return np.concatenate(values, axis=1), places, x

    def logits(self, ids, first, size) -> np.ndarray:
        if not len(first):
            return np.zeros(0)
        return self.pooled(ids, first, size)[0] @ self.out + self.shift

    def scores(self, column) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.logits(*features(column)) + b, -30, 30)))


def _features_of(texts: list[str], together: int = 256):
    """``features`` of many texts, some at a time to bound the memory of their names."""
    pad = max(WIDTHS) - 1
    parts = [features(pa.array(texts[i:i + together], pa.string()))
             for i in range(0, len(texts), together)] or [features(pa.array([], pa.string()))]
    begin = np.cumsum([0] + [len(p[0]) - pad for p in parts])
    return (np.concatenate([p[0][:-pad] for p in parts] + [parts[-1][0][-pad:]]),
            np.concatenate([p[1] + b for p, b in zip(parts, begin)]),
            np.concatenate([p[2] for p in parts]))


def _pieces(ids, first, size, rows):
    """The positions of some texts, as ``features`` gives them."""
    pad = max(WIDTHS) - 1
    take = np.concatenate([np.arange(first[r], first[r] + size[r] + pad) for r in rows])
    each = size[rows] + pad
    return ids[np.minimum(take, len(ids) - 1)], np.cumsum(each) - each, size[rows]


def fit(texts: list[str], labels: np.ndarray, langs: list[str | None], seed: int = 5) -> Model:
    """Train on four fifths of the texts; calibrate score and thresholds on the rest.

    The first entry of a bucket's vector starts as the smoothed log-odds of label 1 among the
    texts that hold it and each width's first filter starts by reading it; all else starts at
    random and all of it is trained by log loss, max pooling passing gradients to the position
    that answered most. With one class only, the score is its share throughout.
    """
    rng = np.random.default_rng(seed)
    ids, first, size = _features_of(texts)
    y = labels.astype(np.float64)
    n = len(y)
    table = rng.normal(0, 0.1, (BUCKETS + 1, SIZE)).astype(np.float32)
    table[:, 0] = 0
    model = Model(table, [rng.normal(0, 0.2, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS],
                  [np.full(FILTERS, -0.1, np.float32) for _ in WIDTHS],
                  rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32))
    share = (y.sum() + 1) / (n + 2)
    model.shift = float(np.log(share / (1 - share)))
    if n < 10 or y.min() == y.max():
        model.out[:] = 0
        table[BUCKETS] = 0
        return model
    order = rng.permutation(n)
    held, own = order[: n // 5], order[n // 5:]
    with_one, with_any = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for k in own:
        seen = np.unique(ids[first[k]:first[k] + size[k]])
        with_any[seen] += 1
        with_one[seen] += y[k]
    table[:, 0] = np.log((with_one + PRIOR * share) / (with_any - with_one + PRIOR * (1 - share))
                         * (1 - share) / share) / len(HEADS)
    table[BUCKETS] = 0
    for w in range(len(WIDTHS)):
        model.filters[w][:, 0, 0] = 1.0
        model.out[w * FILTERS] = 0.5
    steps = {"table": np.full(BUCKETS + 1, 1e-2, np.float32)}
    for _ in range(EPOCHS):
        for chunk in np.array_split(rng.permutation(own), max(1, len(own) // BATCH)):
            _step(model, *_pieces(ids, first, size, chunk), y[chunk], steps)
    raw = model.logits(*_pieces(ids, first, size, held)) if len(held) else np.zeros(0)
    model.scale = _calibrated(raw, y[held])
    a, b = model.scale
    score = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
    tongue = np.array([langs[i] or "" for i in held])
    model.thresholds = {"*": _best_threshold(score, y[held])}
    for lang in np.unique(tongue):
        mine = tongue == lang
        if mine.sum() >= OWN_THRESHOLD and 0 < y[held][mine].sum() < mine.sum():
            model.thresholds[str(lang)] = _best_threshold(score[mine], y[held][mine])
    return model


def _step(model: Model, ids, first, size, y, steps) -> None:
    """One step of adaptive gradient descent on a few texts."""
    values, places, x = model.pooled(ids, first, size, where=True)
    p = 1 / (1 + np.exp(-np.clip(values @ model.out + model.shift, -30, 30)))
    error = ((p - y) / len(y)).astype(np.float32)
    back = error[:, None] * model.out[None, :] * (values > 0)
    g_out = values.T @ error + 1e-4 * model.out
    g_x = np.zeros_like(x)
    for w, width in enumerate(WIDTHS):
        part, place = back[:, w * FILTERS:(w + 1) * FILTERS], places[w]
        g = np.zeros_like(model.filters[w])
        for k in range(width):
            at = np.minimum(place + k, len(x) - 1)
            for j in range(FILTERS):
                live = np.flatnonzero(part[:, j])
                if len(live):
                    g[k, :, j] = part[live, j] @ x[at[live, j]]
                    np.add.at(g_x, at[live, j], part[live, j][:, None]
                              * model.filters[w][k, :, j][None, :])
        for name, value, grad in ((f"f{w}", model.filters[w], g + 1e-4 * model.filters[w]),
                                  (f"b{w}", model.bias[w], part.sum(0))):
            kept = steps.setdefault(name, np.full(value.shape, 1e-2, np.float32))
            kept += grad * grad
            value -= RATE * grad / np.sqrt(kept)
    kept = steps.setdefault("out", np.full(g_out.shape, 1e-2, np.float32))
    kept += g_out * g_out
    model.out -= RATE * g_out / np.sqrt(kept)
    model.shift -= RATE * float(error.sum())
    moved = np.flatnonzero(np.abs(g_x).sum(1))
    for k in range(ids.shape[1]):
        real = moved[ids[moved, k] < BUCKETS]
        at = ids[real, k]
        np.add.at(steps["table"], at, (g_x[real] ** 2).mean(1))
        np.add.at(model.table, at, -RATE * g_x[real] / np.sqrt(steps["table"][at])[:, None])


def _calibrated(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make the logistic of ``raw`` a probability, by Newton's method."""
    if not len(y) or y.min() == y.max():
        return 1.0, 0.0
    # softened targets keep the slope finite where the classes part cleanly
    up, down = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    w = np.array([1.0, 0.0])
    m = np.stack([raw, np.ones_like(raw)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        h = (m * (p * (1 - p))[:, None]).T @ m + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(h, m.T @ (p - t) + 1e-3 * (w - [1, 0])), -1, 1)
    return float(max(w[0], 1e-2)), float(w[1])


def _best_threshold(score: np.ndarray, y: np.ndarray) -> float:
    """The threshold of best F1, halfway to the next lower score."""
    order = np.argsort(-score, kind="stable")
    s = score[order]
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + y.sum())
    last = np.append(s[1:] != s[:-1], True)
    best = int(np.argmax(np.where(last, f1, -1)))
    return float((s[best] + (s[best + 1] if best + 1 < len(s) else 0)) / 2)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS,
          text_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on at most ``rows`` labelled texts of at most ``text_bytes``, picked by a hash of the id.

    Rows held out by the hash of their id are never used. Labels and ids that are null are left
    out; a document labelled twice counts as 1 if either label is.
    """
    marked = (labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
              .agg(F.max("toxic").alias("toxic")).filter(~held_out(F.col("doc_id")))
              .orderBy(F.xxhash64(F.col("doc_id").cast("long")), "doc_id").limit(rows))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select("doc_id", "text", lang.alias("lang")).filter(
        (F.octet_length("text") <= text_bytes) & F.col("text").isNotNull())
    # no more than ``rows`` ids, so the texts need no shuffle
    picked = (texts.join(F.broadcast(marked), "doc_id")
              .orderBy(F.xxhash64(F.col("doc_id").cast("long")), "doc_id", "text").limit(rows)
              .select("text", "lang", F.col("toxic").cast("int").alias("toxic")))

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), pa.schema(
            [("text", pa.string()), ("lang", pa.string()), ("toxic", pa.int32())]))
        model = fit(table.column("text").to_pylist(), table.column("toxic").to_numpy(),
                    table.column("lang").to_pylist())
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]})

    # the sample is one bounded partition; a task fits on it, so the driver holds weights only
    row = picked.coalesce(1).mapInArrow(fitted, "model binary").first()
    return pickle.loads(row["model"]) if row else fit([], np.zeros(0), [])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with ``score``, ``predicted`` and ``flagged`` behind them.

    The score reads the whole text and nothing else; ``predicted`` is 1 from ``threshold`` on;
    ``flagged`` uses the threshold calibrated for the row's language (all languages' where it has
    none). A null text is read as empty. Columns of these names in ``docs`` are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    given = [c for c in docs.columns if c not in ("score", "predicted", "flagged")]
    schema = docs.select(given).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("text").fill_null("")
            value = sent.value.scores(text)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(value, pa.float64())], [*b.schema.names, "score"])

    out = docs.select(given).mapInArrow(add, schema.add("score", "double"))
    lang = F.col("lang") if "lang" in given else F.lit("*")
    own = F.lit(model.thresholds.get("*", threshold))
    for name, value in model.thresholds.items():
        own = F.when(lang == name, F.lit(value)).otherwise(own)
    return (out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .withColumn("flagged", F.col("score") >= own))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, flagged`` of every row, by a model trained here."""
    lang = [docs["lang"]] if "lang" in docs.columns else []
    found = score(id_and_text(docs) if not lang else
                  docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *lang),
                  train(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        "predicted", "flagged")
