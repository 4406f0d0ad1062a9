"""English suffix stripping (Porter, 1980) as a cascade of column expressions over distinct terms.

Every step adds columns: the word so far, its shape (one letter per character, ``v`` for a vowel
and ``c`` for a consonant) and what the rule needs of them. The steps are plain SQL that two
engines read alike but for :class:`Dialect`, so a check outside Spark runs the same rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

# The published rule tables, suffix and replacement, in published order.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


@dataclass(frozen=True)
class Dialect:
    """How an engine writes a replacement of all matches and a group in its replacement."""

    flags: str = ""
    group: str = "$1"

    def replaced(self, text: str, pattern: str, new: str) -> str:
        return f"regexp_replace({text}, '{pattern}', '{new.replace('$1', self.group)}'{self.flags})"


SPARK = Dialect()


def shape(word: str, to: Dialect) -> str:
    """A ``y`` is a vowel after a consonant only; consonant ones are first set in capitals."""
    known = to.replaced(to.replaced(word, "^y", "Y"), "([aeiou])y", "$1Y")
    known = f"replace({known}, 'yy', 'yY')"
    return to.replaced(to.replaced(known, "[^aeiouy]", "c"), "[aeiouy]", "v")


def head(text: str, cut: str | int) -> str:
    return f"left({text}, greatest(length({text}) - {cut}, 0))"


def measure(of: str) -> str:
    """Twice the number of times a vowel is followed by a consonant."""
    return f"(length({of}) - length(replace({of}, 'vc', '')))"


def hissing(word: str, of: str) -> str:
    """Consonant, vowel, consonant at the end, the last none of w, x, y."""
    return f"({of} LIKE '%cvc' AND right({word}, 1) NOT IN ('w', 'x', 'y'))"


def suffix_of(word: str, suffixes) -> str:
    """The longest of the suffixes that ends the word, or an empty string."""
    return f"regexp_extract({word}, '({'|'.join(suffixes)})$', 0)"


def replacing(rules, word: str, to: Dialect) -> list[dict[str, str]]:
    """Levels that replace the longest suffix of a table after a stem with a measure."""
    new = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in rules)
    return [
        {"ending": suffix_of(word, [old for old, _ in rules]), "form": shape(word, to)},
        {"form": head("form", "length(ending)")},
        {word: f"CASE WHEN ending <> '' AND {measure('form')} > 0 THEN "
               f"{head(word, 'length(ending)')} || CASE ending {new} END ELSE {word} END"},
    ]


def levels(term: str, to: Dialect = SPARK) -> list[dict[str, str]]:
    """Columns to add, level by level; the last level leaves the stem in ``stem``."""
    return [
        # plural endings
        {"stem": f"""CASE WHEN {term} LIKE '%sses' OR {term} LIKE '%ies' THEN {head(term, 2)}
            WHEN {term} LIKE '%s' AND {term} NOT LIKE '%ss' THEN {head(term, 1)} ELSE {term} END"""},
        # past and progressive endings, and what their loss asks for
        {"form": shape("stem", to)},
        {"cut": f"""CASE WHEN stem LIKE '%eed' THEN NULL
            WHEN stem LIKE '%ed' AND {head('form', 2)} LIKE '%v%' THEN {head('stem', 2)}
            WHEN stem LIKE '%ing' AND {head('form', 3)} LIKE '%v%' THEN {head('stem', 3)} END"""},
        {"cut_form": "left(form, length(cut))"},
        {"stem": f"""CASE
            WHEN stem LIKE '%eed' AND {measure(head('form', 3))} > 0 THEN {head('stem', 1)}
            WHEN cut IS NULL THEN stem
            WHEN cut LIKE '%at' OR cut LIKE '%bl' OR cut LIKE '%iz' THEN cut || 'e'
            WHEN cut_form LIKE '%cc' AND right(cut, 1) = left(right(cut, 2), 1)
                 AND right(cut, 1) NOT IN ('l', 's', 'z') THEN {head('cut', 1)}
            WHEN {measure('cut_form')} = 2 AND {hissing('cut', 'cut_form')} THEN cut || 'e'
            ELSE cut END"""},
        # y after a vowel further ahead
        {"form": shape("stem", to)},
        {"stem": f"""CASE WHEN stem LIKE '%y' AND {head('form', 1)} LIKE '%v%'
            THEN {head('stem', 1)} || 'i' ELSE stem END"""},
        # double and single derivational endings
        *replacing(STEP_2, "stem", to),
        *replacing(STEP_3, "stem", to),
        {"ending": suffix_of("stem", STEP_4), "form": shape("stem", to)},
        {"form": head("form", "length(ending)"), "cut": head("stem", "length(ending)")},
        {"stem": f"""CASE WHEN ending <> '' AND {measure('form')} > 2
            AND (ending <> 'ion' OR right(cut, 1) IN ('s', 't')) THEN cut ELSE stem END"""},
        # final e and double l
        {"form": shape("stem", to)},
        {"cut": head("stem", 1), "cut_form": head("form", 1)},
        {"stem": f"""CASE WHEN stem LIKE '%e' AND ({measure('cut_form')} > 2
            OR ({measure('cut_form')} = 2 AND NOT {hissing('cut', 'cut_form')}))
            THEN cut ELSE stem END"""},
        {"form": shape("stem", to)},
        {"stem": f"""CASE WHEN length({term}) < 3 THEN {term}
            WHEN stem LIKE '%ll' AND {measure('form')} > 2 THEN {head('stem', 1)} ELSE stem END"""},
    ]


def stems(terms: DataFrame, term: str = "term") -> DataFrame:
    """``terms`` with a column ``stem``; words of one or two letters stay as they are.

    Meant for distinct lower-cased terms: the work is per row, so once per term of a vocabulary.
    """
    kept = [c for c in terms.columns if c != "stem"]
    out = terms.select(*kept)
    for level in levels(term):
        out = out.selectExpr(*[c for c in out.columns if c not in level],
                             *[f"{sql} AS {name}" for name, sql in level.items()])
    return out.select(*kept, "stem")


def stems_sql(source: str, term: str = "term", to: Dialect = SPARK) -> str:
    """A query over the table ``source`` giving its columns and ``stem``."""
    query, have = f"SELECT {term} FROM {source}", [term]
    for level in levels(term, to):
        old = [c for c in have if c not in level]
        query = (f"SELECT {', '.join(old)}, "
                 f"{', '.join(f'{sql} AS {name}' for name, sql in level.items())} FROM ({query})")
        have = old + list(level)
    return f"SELECT {term}, stem FROM ({query})"
