"""Porter (1980) suffix stripping, with the author's two later points (bli, logi).

Each step is a suffix table; the measure of a stem is the number of vowel-consonant sequences.
"""

from __future__ import annotations

import re

# Suffix tables of the published algorithm.
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"),
    ("biliti", "ble"), ("logi", "log"),
)
STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _longest_first(table):
    return sorted(table, key=lambda row: -len(row if isinstance(row, str) else row[0]))


_STEP2, _STEP3, _STEP4 = _longest_first(STEP2), _longest_first(STEP3), _longest_first(STEP4)


def _shape(word: str) -> str:
    """The word as c/v letters; y is a vowel after a consonant."""
    shape = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and shape[-1] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _ends_cvc(stem: str) -> bool:
    return _shape(stem).endswith("cvc") and stem[-1] not in "wxy"


def _doubled(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def _replace(word: str, table) -> str:
    for suffix, target in table:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + target if _measure(stem) > 0 else word
    return word


def stem_word(word: str) -> str:
    """Stem of one lower-case word; words of one or two letters are returned unchanged."""
    if len(word) < 3:
        return word

    # Plurals.
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]

    # Past and progressive forms.
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            stem = word[: -len(suffix)]
            if word.endswith(suffix) and "v" in _shape(stem):
                if stem.endswith(("at", "bl", "iz")):
                    word = stem + "e"
                elif _doubled(stem) and stem[-1] not in "lsz":
                    word = stem[:-1]
                elif _measure(stem) == 1 and _ends_cvc(stem):
                    word = stem + "e"
                else:
                    word = stem
                break

    # Final y.
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"

    # Derivational suffixes.
    word = _replace(word, _STEP2)
    word = _replace(word, _STEP3)
    for suffix in _STEP4:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem[-1] in "st"):
                word = stem
            break

    # Final e and double l.
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _ends_cvc(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word
