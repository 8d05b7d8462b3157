"""Shared fragments of the check SQL (ANSI SQL with DuckDB's list and text functions).

Written against the published definitions, independently of the Spark expressions.
"""

from __future__ import annotations

from marquee.functions.porter import STEP2, STEP3, STEP4

_L = r"[\p{L}\p{M}\p{Nl}]"
WORD = rf"(?:{_L}+(?:[.:''’·]{_L}+)*|\p{{Nd}}+(?:[.,;''’]\p{{Nd}}+)*|_+)+"
# The 33 English stop words, written out apart from those of the library.
STOPS = (
    "'a', 'an', 'and', 'are', 'as', 'at', 'be', 'but', 'by', 'for', 'if', 'in', 'into', 'is', 'it', 'no', 'not', 'of', 'on', "
    "'or', 'such', 'that', 'the', 'their', 'then', 'there', 'these', 'they', 'this', 'to', 'was', 'will', 'with'"
)


def folded(text: str) -> str:
    whole = f"strip_accents(lower({text}))"
    for letter, ascii_form in (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("’", "''"), ("ﬁ", "fi"), ("ﬂ", "fl")):
        whole = f"replace({whole}, '{letter}', '{ascii_form}')"
    return whole


def tokens(text: str) -> str:
    """Words of the text as it is, each then lower-cased and folded."""
    return f"list_transform(regexp_extract_all({text}, '{WORD}'), lambda t: {folded('t')})"


def no_possessive(toks: str) -> str:
    return f"list_transform({toks}, lambda t: regexp_replace(t, '''s$', ''))"


def no_stops(toks: str) -> str:
    return f"list_filter({toks}, lambda t: t NOT IN ({STOPS}))"


def english(text: str) -> str:
    """Tokens ready for stemming."""
    return no_stops(no_possessive(tokens(text)))


# Porter's algorithm by regular expressions over consonant (C) and vowel (V) runs; an initial y is
# written Y so that it counts as a consonant.
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_M0 = f"^({_C})?{_V}{_C}"
_M1 = f"^({_C})?{_V}{_C}({_V})?$"
_M2 = f"^({_C})?{_V}{_C}{_V}{_C}"
_HAS_V = f"^({_C})?[aeiouy]"
_CVC = f"^{_C}[aeiouy][^aeiouwxyY]$"


def _cut(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _suffixes(table) -> str:
    whens = []
    for suffix, target in sorted(table, key=lambda r: -len(r[0])):
        stem = _cut(len(suffix))
        whens.append(
            f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN regexp_matches({stem}, '{_M0}') THEN {stem} || '{target}' ELSE w END"
        )
    return "CASE " + " ".join(whens) + " ELSE w END"


def stems(words: str) -> str:
    """CTE text defining ``stemmed(term, stem)`` for the distinct words of relation ``words(term)``."""

    def fixed(stem: str) -> str:
        return (
            f"CASE WHEN regexp_matches({stem}, '(at|bl|iz)$') THEN {stem} || 'e' "
            f"WHEN length({stem}) > 1 AND right({stem}, 1) = substr({stem}, length({stem}) - 1, 1) "
            f"AND regexp_matches({stem}, '[^aeiouylsz]$') THEN left({stem}, length({stem}) - 1) "
            f"WHEN regexp_matches({stem}, '{_CVC}') THEN {stem} || 'e' ELSE {stem} END"
        )

    step1b = (
        f"CASE WHEN ends_with(w, 'eed') THEN CASE WHEN regexp_matches({_cut(3)}, '{_M0}') THEN {_cut(1)} ELSE w END "
        f"WHEN ends_with(w, 'ed') AND regexp_matches({_cut(2)}, '{_HAS_V}') THEN {fixed(_cut(2))} "
        f"WHEN ends_with(w, 'ing') AND regexp_matches({_cut(3)}, '{_HAS_V}') THEN {fixed(_cut(3))} ELSE w END"
    )
    step4 = []
    for suffix in sorted(STEP4, key=lambda s: -len(s)):
        stem = _cut(len(suffix))
        extra = f" AND regexp_matches({stem}, '[st]$')" if suffix == "ion" else ""
        step4.append(
            f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN regexp_matches({stem}, '{_M2}'){extra} THEN {stem} ELSE w END"
        )
    steps = [
        f"CASE WHEN regexp_matches(w, '(ss|i)es$') THEN {_cut(2)} "
        f"WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN {_cut(1)} ELSE w END",
        step1b,
        f"CASE WHEN ends_with(w, 'y') AND regexp_matches({_cut(1)}, '{_HAS_V}') THEN {_cut(1)} || 'i' ELSE w END",
        _suffixes(STEP2),
        _suffixes(STEP3),
        "CASE " + " ".join(step4) + " ELSE w END",
        f"CASE WHEN ends_with(w, 'e') AND (regexp_matches({_cut(1)}, '{_M2}') OR (regexp_matches({_cut(1)}, '{_M1}') "
        f"AND NOT regexp_matches({_cut(1)}, '{_CVC}'))) THEN {_cut(1)} ELSE w END",
        f"CASE WHEN ends_with(w, 'll') AND regexp_matches({_cut(1)}, '{_M2}') THEN {_cut(1)} ELSE w END",
    ]
    ctes = [f"_s0 AS (SELECT DISTINCT term, regexp_replace(term, '^y', 'Y') AS w FROM {words} WHERE length(term) > 2)"]
    for i, step in enumerate(steps):
        ctes.append(f"_s{i + 1} AS MATERIALIZED (SELECT term, {step} AS w FROM _s{i})")
    ctes.append(
        f"stemmed AS MATERIALIZED (SELECT term, lower(w) AS stem FROM _s{len(steps)} "
        f"UNION ALL SELECT DISTINCT term, term FROM {words} WHERE length(term) <= 2)"
    )
    return ", ".join(ctes)


def bm25(n: str, df: str, tf: str, dl: str, avgdl: str) -> str:
    return f"ln(1 + ({n} - {df} + 0.5) / ({df} + 0.5)) * {tf} / ({tf} + 1.2 * (1 - 0.75 + 0.75 * {dl} / {avgdl}))"


def squared_l2(a: str, b: str) -> str:
    return (
        f"list_sum(list_transform(list_zip({a}, {b}), lambda p: "
        "(CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) * (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE))))"
    )
