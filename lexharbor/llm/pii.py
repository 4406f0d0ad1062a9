"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWEST, id_and_text, small_batches

# Kinds in their order and their patterns. The guards before and in the patterns
# only spare starts that cannot match.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
ACTIVE = re.compile(r"[0-9@]|[\[({](?:at|dot)[\])}]", re.I)
TOKEN = re.compile(r"[\[({](?:at|dot)[\])}]|[A-Za-z]+|[0-9]+|\s+|[^A-Za-z0-9\s]", re.I)
HIDDEN_AT = re.compile(r"\s?[\[({]at[\])}]\s?", re.I)
HIDDEN_DOT = re.compile(r"\s?[\[({]dot[\])}]\s?", re.I)
MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Longest entity in tokens, and tokens of plain text kept around what may be one.
LONGEST, AROUND = 24, 3
# Bounds of the sample the field is fitted on: documents and bytes of each.
SAMPLE_ROWS, SAMPLE_BYTES = 300, 16 << 10
# What a text of the sample may hold, by kind: enough to pick it, the spans are found afterwards.
HINTS = (r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]+\.[A-Za-z0-9-]", r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]",
         r"[0-9]([\x20-]?[0-9]){15}", r"\+[0-9][\x20().0-9-]{6}")
EPOCHS, RATE, PENALTY = 6, 0.3, 1e-3


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start; code points, end exclusive."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        left = at
        while left > free and text[left - 1] in LOCAL:
            left -= 1
        found = DOMAIN.match(text, at + 1) if left < at else None
        if found:
            free = found.end()
            out.append((0, left, free))
        at = text.find("@", max(at + 1, free))
    if not DIGITS.search(text):
        return out
    out += [(1, m.start(), m.end()) for m in IP.finditer(text)
            if all(_small(p) for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text)
            if 8 <= len(DIGITS.findall(m.group())) <= 15]
    return out


def _small(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 3 or (len(digits) == 3 and digits <= "255")


@dataclass
class Region:
    """Tokens around possible entities, and the candidate segments (from, to, features)."""

    bounds: list[int]
    plain: list[tuple[int, ...]]
    segments: list[tuple[int, int, tuple[int, ...]]]
    gold: list[int] = field(default_factory=list)


def _features(text: str, a: int, b: int, tokens: int) -> list[str]:
    """Whole-span features of ``text[a:b]`` as an entity."""
    s = text[a:b]
    digits = DIGITS.findall(s)
    n = len(digits)
    size = next(k for k, top in enumerate((0, 3, 7, 9, 11, 15, 19, 10 ** 9)) if n <= top)
    bare = HIDDEN_DOT.sub(".", HIDDEN_AT.sub("@", s))
    mail = bool(MAIL.fullmatch(bare))
    parts = s.split(".")
    ip = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    chars = "".join(sorted({"d" if c in "0123456789" else "l" if c.isalpha() else
                            "s" if c == " " else c for c in s}))
    card = n >= 16 and not set(chars) - set("d s-".replace(" ", "")) and luhn("".join(digits))
    before = text[a - 1:a]
    after = text[b:b + 1]
    edge = ("w" if before.isalnum() else before if before in "+-.@(_" else "o",
            "w" if after.isalnum() else after if after in "-@)_" else
            "." if after == "." and text[b + 1:b + 2].isalnum() else "o")
    return [f"chars={chars}", f"n={size}", f"mail={mail}", f"ip={ip}", f"card={card},{size}",
            f"ip={ip},{ip and all(_small(p) for p in parts)}", f"first={_class(s[0])}",
            f"last={_class(s[-1])}", f"edge0={edge[0]}", f"edge1={edge[1]}",
            f"plus={s[0] == '+'},{size}", f"group={_groups(s)},{size}", f"mail={mail},{edge}",
            f"at={s.count('@')}", f"long={min(tokens, 12) // 3}", f"edges={edge},{ip},{size}"]


def _class(c: str) -> str:
    return "d" if c.isdigit() else "l" if c.isalpha() else c


def _groups(s: str) -> str:
    return re.sub(r"[0-9]+", lambda m: str(min(len(m.group()), 9)), s) if len(s) < 24 else "long"


class Names(dict):
    """Numbers for feature names; unknown ones are dropped once ``fixed``."""

    fixed = False

    def of(self, names: list[str]) -> tuple[int, ...]:
        if self.fixed:
            return tuple(self[n] for n in names if n in self)
        return tuple(self.setdefault(n, len(self)) for n in names)


def regions(text: str, names: Names) -> Iterator[Region]:
    """Parts of a text that may hold entities; a segment holds a digit or an at sign.

    What is left out is plain text in every labelling, so the parts are independent.
    """
    seeds = [m.start() for m in ACTIVE.finditer(text)]
    if not seeds:
        return
    reach = 16 * LONGEST
    groups: list[list[int]] = []
    for s in seeds:
        if groups and s - groups[-1][1] <= 2 * reach:
            groups[-1][1] = s
        else:
            groups.append([s, s])
    for low, high in groups:
        tokens = [(m.start(), m.end()) for m in
                  TOKEN.finditer(text, max(0, low - reach), min(len(text), high + reach))]
        kinds = []
        for a, b in tokens:
            s = text[a:b]
            kinds.append("s" if s == " " else "n" if s.isspace() else "x" if ACTIVE.search(s) else
                         "l" if s[0].isalpha() else "+" if s in "+(" else "p" if s in "._%-)" else "o")
        found = []
        for i, k in enumerate(kinds):
            if k not in "xl+":
                continue
            active = False
            for j in range(i, min(len(kinds), i + LONGEST)):
                kind = kinds[j]
                if kind in "no" or (kind == "l" and j >= 2 and j - 1 > i and kinds[j - 1] == "s"
                                    and tokens[j - 2] and "[" not in text[tokens[j - 2][0]:tokens[j - 2][1]]
                                    and "(" not in text[tokens[j - 2][0]:tokens[j - 2][1]]):
                    break
                if kind == "s" and j > i and kinds[j - 1] == "l":
                    nxt = text[tokens[j + 1][0]:tokens[j + 1][1]] if j + 1 < len(tokens) else ""
                    if nxt[:1] not in ("[", "(", "{"):
                        break
                active |= kind == "x"
                if active and kind in "xl" and (k != "l" or i == 0 or kinds[i - 1] not in "xl"):
                    found.append((i, j + 1))
        if not found:
            continue
        used = [False] * len(tokens)
        for i, j in found:
            for t in range(max(0, i - AROUND), min(len(tokens), j + AROUND)):
                used[t] = True
        t = 0
        while t < len(tokens):
            if not used[t]:
                t += 1
                continue
            end = t
            while end < len(tokens) and used[end]:
                end += 1
            own = [(i, j) for i, j in found if t <= i and j <= end]
            yield Region(
                [tokens[x][0] for x in range(t, end)] + [tokens[end - 1][1]],
                [names.of([f"plain={kinds[x]}",
                           f"plain={kinds[x]},{min(tokens[x][1] - tokens[x][0], 4)}"])
                 for x in range(t, end)],
                [(i - t, j - t, names.of(_features(text, tokens[i][0], tokens[j - 1][1], j - i)))
                 for i, j in own])
            t = end


@dataclass
class SemiMarkov:
    """Weights of segment features by type, of plain tokens, and between neighbouring types."""

    names: Names
    kinds: np.ndarray      # features x entity types
    plain: np.ndarray      # features
    steps: np.ndarray      # type before x type, plain text last

    def potentials(self, r: Region):
        o = np.array([self.plain[list(f)].sum() if f else 0.0 for f in r.plain])
        s = np.array([self.kinds[list(f)].sum(0) if f else np.zeros(len(KINDS))
                      for _, _, f in r.segments]).reshape(-1, len(KINDS))
        return o, s

    def best(self, r: Region) -> list[tuple[int, int, int]]:
        """(kind, start, end) of the entities in the segmentation of greatest score."""
        o, s = self.potentials(r)
        n, last = len(r.plain), len(KINDS)
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (_, j, _) in enumerate(r.segments):
            ending[j].append(k)
        top = np.full((n + 1, last + 1), -np.inf)
        top[0, last] = 0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for j in range(1, n + 1):
            way = top[j - 1] + self.steps[:, last]
            t = self._greatest(way)
            top[j, last], back[j, last] = way[t] + o[j - 1], (j - 1, t)
            for k in ending[j]:
                i = r.segments[k][0]
                way = top[i][:, None] + self.steps[:, :last] + s[k]
                t = way.argmax(0)
                value = way[t, np.arange(last)]
                for kind in np.flatnonzero(value > top[j, :last]):
                    top[j, kind], back[j, int(kind)] = value[kind], (i, int(t[kind]))
        out, j, t = [], n, self._greatest(top[n])
        while j:
            i, before = back[j, t]
            if t < last:
                out.append((t, r.bounds[i], r.bounds[j]))
            j, t = i, before
        return out[::-1]

    @staticmethod
    def _greatest(scores: np.ndarray) -> int:
        """The type of greatest score; ties go to plain text."""
        return len(KINDS) if scores[-1] >= scores.max() else int(scores.argmax())

    def gradient(self, r: Region, g_kinds, g_plain, g_steps) -> float:
        """Add the gradient of the log-likelihood of the gold labels; returns the likelihood."""
        o, s = self.potentials(r)
        n, last = len(r.plain), len(KINDS)
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (i, j, _) in enumerate(r.segments):
            ending[j].append(k)
            starting[i].append(k)
        fore = np.full((n + 1, last + 1), -1e30)
        fore[0, last] = 0
        enter = np.empty((n + 1, last + 1))
        for j in range(n + 1):
            if j:
                fore[j, last] = enter[j - 1, last] + o[j - 1]
                if ending[j]:
                    way = np.array([enter[r.segments[k][0], :last] + s[k] for k in ending[j]])
                    fore[j, :last] = np.logaddexp.reduce(way, 0)
            enter[j] = np.logaddexp.reduce(fore[j][:, None] + self.steps, 0)
        whole = np.logaddexp.reduce(fore[n])
        rear = np.full((n + 1, last + 1), -1e30)
        rear[n] = 0
        leave = np.full((n + 1, last + 1), -1e30)
        for i in range(n - 1, -1, -1):
            out = np.full(last + 1, -1e30)
            out[last] = o[i] + rear[i + 1, last]
            if starting[i]:
                way = np.array([s[k] + rear[r.segments[k][1], :last] for k in starting[i]])
                out[:last] = np.logaddexp.reduce(way, 0)
            leave[i] = out
            rear[i] = np.logaddexp.reduce(self.steps + out[None, :], 1)
        for i in range(n):
            g_steps -= np.exp(np.minimum(fore[i][:, None] + self.steps + leave[i][None, :] - whole, 0))
            p = np.exp(min(enter[i, last] + o[i] + rear[i + 1, last] - whole, 0.0))
            g_plain[list(r.plain[i])] -= p
        for k, (i, j, f) in enumerate(r.segments):
            g_kinds[list(f)] -= np.exp(np.minimum(
                enter[i, :last] + s[k] + rear[j, :last] - whole, 0))
        # the gold labelling
        value, at, before = 0.0, 0, last
        gold = {r.segments[k // last][0]: (k // last, k % last) for k in r.gold}
        while at < n:
            if at in gold:
                k, kind = gold[at]
                g_kinds[list(r.segments[k][2]), kind] += 1
                value += self.steps[before, kind] + s[k][kind]
                g_steps[before, kind] += 1
                at, before = r.segments[k][1], kind
            else:
                g_plain[list(r.plain[at])] += 1
                g_steps[before, last] += 1
                value += self.steps[before, last] + o[at]
                at, before = at + 1, last
        return value - whole


def _marked(text: str, spans: list[tuple[int, int, int]], names: Names) -> list[Region]:
    """Regions with the labels of ``spans``; regions that cannot show one of theirs are left out."""
    out = []
    for r in regions(text, names):
        here = [x for x in spans if r.bounds[0] <= x[1] and x[2] <= r.bounds[-1]]
        where = {(r.bounds[i], r.bounds[j]): k for k, (i, j, _) in enumerate(r.segments)}
        free, ok = 0, True
        for kind, a, b in sorted(here, key=lambda x: x[1]):
            if a < free:
                continue
            k = where.get((a, b))
            if k is None:
                ok = False
                break
            r.gold.append(k * len(KINDS) + kind)
            free = b
        if ok:
            out.append(r)
    return out


def respelt(text: str, spans: list[tuple[int, int, int]], how) -> tuple[str, list]:
    """A copy of a text with each span as ``how`` spells it, and the spans that still are ones.

    ``how(kind, spelling, n)`` gives the new spelling and whether it still is an entity.
    """
    out, new, at, size = [], [], 0, 0
    for n, (kind, a, b) in enumerate(sorted(spans, key=lambda x: x[1])):
        if a < at:
            continue
        s, real = how(kind, text[a:b], n)
        out += [text[at:a], s]
        size += a - at
        if real:
            new.append((kind, size, size + len(s)))
        size += len(s)
        at = b
    return "".join(out) + text[at:], new


def varied(kind: int, s: str, n: int) -> tuple[str, bool]:
    """Another spelling that people use."""
    if kind == 0:
        mark = ("[{}]", " [{}] ", "({})", " ({}) ")[n % 4]
        s = s.replace("@", mark.format("at")).replace(".", mark.format("dot"))
    elif kind == 3:
        s = re.sub(r"^\+[0-9]+[ .-]?", "", s)
    return s, True


def spoilt(kind: int, s: str, n: int) -> tuple[str, bool]:
    """A spelling that is no entity: a part above 255, a failing check digit, too few digits."""
    if kind == 1:
        parts = s.split(".")
        parts[n % 4] = str(256 + 97 * n % 9000)
        return ".".join(parts), False
    if kind == 2:
        return s[:-1] + str((int(s[-1]) + 1 + n % 9) % 10), False
    if kind == 3:
        return DIGITS.sub("", s[:-5]) + s[-4:], False
    return s, True


def examples(n: int = 24) -> list[str]:
    """Made-up texts that hold every kind, so that a kind rare in the sample is known too."""
    rng = np.random.default_rng(3)
    out = []
    for k in range(n):
        ip = ".".join(str(x) for x in rng.integers(0, 256, 4))
        head = "".join(str(x) for x in rng.integers(0, 10, 15 + k % 3))
        card = next(head + str(d) for d in range(10) if luhn(head + str(d)))
        if k % 2:
            card = "- "[k // 2 % 2].join(card[i:i + 4] for i in range(0, len(card), 4))
        a, b, c = (int(x) for x in rng.integers((100, 200, 1000), (999, 999, 9999)))
        phone = (f"+1 ({a}) {b}-{c}", f"+44 {a} {b} {c}", f"+{a}{b}{c}", f"+1-{a}-{b}-{c}")[k % 4]
        out.append(f"write to name{k}.last@host{a}.example.org from {ip}, call {phone} or pay with "
                   f"{card}. It took {k}.{k % 10} of {c} parts in {1900 + k}.")
    return out


def fit(texts: list[str]) -> SemiMarkov:
    """Fit the field to the fixed patterns' spans, other spellings of them, and near misses.

    The texts are joined by ``examples``.
    """
    names = Names()
    data: list[Region] = []
    for text in [*texts, *examples()]:
        spans = base_spans(text)
        data += _marked(text, spans, names)
        data += _marked(*respelt(text, spans, varied), names)
        data += _marked(*respelt(text, spans, spoilt), names)
    names.fixed = True
    m = SemiMarkov(names, np.zeros((len(names) + 1, len(KINDS))), np.zeros(len(names) + 1),
                   np.zeros((len(KINDS) + 1, len(KINDS) + 1)))
    weights = (m.kinds, m.plain, m.steps)
    seen = [np.full(w.shape, 1e-3) for w in weights]
    order = np.random.default_rng(2)
    for _ in range(EPOCHS):
        for rows in np.array_split(order.permutation(len(data)), max(1, len(data) // 16)):
            grads = [np.zeros_like(w) for w in weights]
            for k in rows:
                m.gradient(data[k], *grads)
            for w, g, v in zip(weights, grads, seen, strict=True):
                g -= PENALTY * w * len(rows)
                v += g * g
                w += RATE * g / np.sqrt(v)
    return m


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, text_bytes: int = SAMPLE_BYTES) -> SemiMarkov:
    """Fit on at most ``rows`` different texts of at most ``text_bytes``, of every kind as many.

    A text stands for a kind if it matches the kind's hint and its hash is under a bound that
    about so many texts of the kind pass, so no task orders more than the sample.
    """
    share = max(1, rows // (2 * len(KINDS)))
    hashed = (docs.filter(F.octet_length("text") <= text_bytes)
              .select("text", F.xxhash64("text").alias("h")))
    held = [F.col("text").rlike(hint) for hint in HINTS]
    known = hashed.agg(*[F.approx_count_distinct(F.when(x, F.col("h"))).alias(k)
                         for k, x in zip(KINDS, held, strict=True)]).first()
    chosen = F.lit(False)
    for kind, x in zip(KINDS, held, strict=True):
        bound = LOWEST + min(2 ** 64 - 1, share * 2 ** 64 // max(known[kind], 1))
        chosen |= (F.col("h") <= bound) & x
    picked = (hashed.filter(chosen).groupBy("text").agg(F.min("h").alias("h"))
              .orderBy("h").limit(rows).select("text").toArrow())
    return fit(picked.column("text").to_pylist())


def all_spans(text: str, model: SemiMarkov) -> tuple[list, list]:
    """The fixed patterns' spans, and all spans; both by kind, then start."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for r in regions(text, model.names):
        for kind, a, b in model.best(r):
            if not any(x < b and a < y for x, y in taken):
                added.append((kind, a, b))
    return base, sorted(base + added)


def find(docs: DataFrame, model: SemiMarkov | None = None) -> DataFrame:
    """``doc_id, spans, text``: spans as structs ``kind, start, end, base`` of every whole text.

    Kinds are ``KINDS``; offsets are code points. Spans of the fixed patterns always stay; the
    field's spans are added where they overlap none. A null text is empty; rows that repeat are
    each given their own; extra columns are not read. Without ``model`` one is trained on ``docs``.
    """
    small_batches(docs.sparkSession)
    source = id_and_text(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model or train(source))
    kind = "array<struct<kind:string,start:long,end:long,base:boolean>>"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                          ("base", pa.bool_())])
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                base, spans = all_spans(text, sent.value)
                known = set(base)
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "base": (k, s, e) in known}
                             for k, s, e in spans])
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "spans": pa.array(rows, pa.list_(item)),
                "text": b.column("text")})

    return source.mapInArrow(each, f"doc_id long, spans {kind}, text string")


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their hash, and all spans as text."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == kind))).cast("long")

    base = F.filter("spans", lambda x: x["base"])
    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
