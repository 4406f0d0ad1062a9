"""Column expressions over text: tokens, titles, lengths, marks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns. WORDS takes runs of letters and digits; WORDS_JOINED
# also keeps an inner ' . : between letters and . , ; ' between digits.
WORDS = r"[\p{L}\p{N}]+"
WORDS_JOINED = (
    r"[\p{L}\p{M}\p{N}_]+(?:(?:(?<=[\p{L}\p{M}_])['’.:](?=[\p{L}_])"
    r"|(?<=\p{N})[.,;'’](?=\p{N}))[\p{L}\p{M}\p{N}_]+)*"
)
# A possessive ending as seen in running text and on one token.
POSSESSIVE_IN_TEXT = r"([\p{L}\p{N}])(?:['’＇][sS])+([^\p{L}\p{N}]|$)"
POSSESSIVE_ON_TOKEN = r"['’＇][sS]$"
APOSTROPHES = ("'", "’", "＇")


def title_of(path: Column) -> Column:
    """File name with every dot turned into a space."""
    return F.replace(F.element_at(F.split(path, "/"), -1), F.lit("."), F.lit(" "))


def words_of(text: Column, pattern: str = WORDS) -> Column:
    """Tokens of ``text`` in order, original case."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def pieces_of(text: Column, pattern: str = WORDS) -> Column:
    """``array<struct<gap, word>>``: every token with the text before it.

    The last entry holds the text after the last token and a null word, so the
    pieces put end to end give back ``text`` exactly.
    """
    return F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                        words_of(text, pattern).alias("word"))


def kept_length(length: Column) -> Column:
    """Field length as the one-byte norm of the ranking keeps it.

    Exact below 40; above, the offset from 24 keeps its top four bits.
    """
    over = (length - F.lit(24)).cast("int")
    drop = F.greatest(F.lit(0), F.length(F.bin(over)) - F.lit(4)).cast("int")
    cut = F.call_function("shiftleft", F.call_function("shiftright", over, drop), drop)
    return F.when(length > 39, F.lit(24) + cut).otherwise(length).cast("int")


def mark(word: Column, hit: Column, pre: str = "<b>", post: str = "</b>") -> Column:
    """``word`` wrapped in tags where ``hit`` holds."""
    return F.when(hit, F.concat(F.lit(pre), word, F.lit(post))).otherwise(word)


def mark_words(text: Column, terms: Column, pre: str = "<b>", post: str = "</b>") -> Column:
    """``text`` with every word tagged whose lower case is among ``terms``."""
    return F.array_join(
        F.transform(pieces_of(text), lambda p: F.concat(
            p["gap"],
            F.coalesce(mark(p["word"], F.array_contains(terms, F.lower(p["word"])), pre, post),
                       F.lit("")))),
        "")


def one_line(text: Column) -> Column:
    """Drop newlines, as snippets are shown on one line."""
    return F.replace(text, F.lit("\n"), F.lit(""))


def path_bucket(path: Column, buckets: int) -> Column:
    """Stable bucket of a document, the unit in which an index is rewritten."""
    return F.pmod(F.xxhash64(path), F.lit(buckets)).cast("int")


def term_slot(term: Column, slots: int) -> Column:
    """Stable folder of a term within a bucket, the unit in which a lookup reads."""
    return F.pmod(F.xxhash64(term), F.lit(slots)).cast("int")


def ancestors_of(path: Column) -> Column:
    """The path itself and every folder above it, as full strings; ``/`` tops an absolute one."""
    parts = F.split(path, "/")
    own = F.filter(
        F.transform(F.sequence(F.lit(1), F.size(parts)),
                    lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")),
        lambda p: p != F.lit(""),
    )
    top = F.when(path.startswith("/"), F.array(F.lit("/"))).otherwise(
        F.array().cast("array<string>"))
    return F.array_distinct(F.concat(top, own))


def prefixes_of(text: Column, lengths: list[int]) -> Column:
    """The prefixes of ``text`` that have one of the given lengths."""
    if not lengths:
        return F.array().cast("array<string>")
    usable = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(text))
    return F.transform(usable, lambda n: F.substring(text, F.lit(1), n))
