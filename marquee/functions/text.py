"""Text analysis as Column expressions: fold, tokenise, possessive, stop words, stems."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.porter import stem_word

ANALYZER_OPTIONS = ("english_stem", "english_no_stem", "standard")

# The 33 English stop words.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is",
    "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there",
    "these", "they", "this", "to", "was", "will", "with",
)

# Letters that fold to ASCII although they have no Unicode decomposition.
FOLD_ONE = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ħ": "h", "Ħ": "H",
            "ı": "i", "ł": "l", "Ł": "L", "ŋ": "n", "Ŋ": "N", "ŧ": "t", "Ŧ": "T",
            "‘": "'", "’": "'", "‛": "'", "＇": "'", "“": '"', "”": '"', "‐": "-", "–": "-", "—": "-"}
FOLD_MANY = {"ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "TH",
             "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}

WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())

MAX_TOKEN_CHARS = 255
# Stems that a task remembers between batches; words over so many characters are rare and not remembered.
STEM_MEMO = 200_000
STEM_MEMO_CHARS = 32

# A word is a run of letters (joined inside by . ' : and the middle dot), of digits (joined by
# . , ; ') or of underscores, in any mix.  Possessive quantifiers make the matcher iterate, not
# recurse, so one very long token cannot exhaust the stack.  Group index 0 is the whole match.
_HAN = r"[\p{IsHan}\p{IsHiragana}]"
# ASCII is named first: most characters are then settled by one table look-up, not by Unicode properties.
_LETTER = r"[A-Za-z[\p{L}\p{M}\p{Nl}&&[^\p{IsHan}\p{IsHiragana}]]]"
_DIGIT = r"[0-9\p{Nd}]"
_WORD = rf"(?:{_LETTER}++(?:[.:'’·]{_LETTER}++)*+|{_DIGIT}++(?:[.,;'’]{_DIGIT}++)*+|_++)++|{_HAN}"


def _fold_table() -> dict[str, str]:
    """Accented Latin letters and their ASCII base, derived from Unicode decompositions."""
    table = dict(FOLD_ONE)
    for code in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)):
        char = chr(code)
        if unicodedata.category(char)[0] not in "LN":
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii():
            table[char] = base
    return table


_FOLD = _fold_table()
_FOLD_FROM, _FOLD_TO = "".join(_FOLD), "".join(_FOLD.values())


def strip(col: Column) -> Column:
    """Trim every Unicode white-space character at both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def ascii_fold(col: Column) -> Column:
    """Replace accented Latin letters by their ASCII base; ASCII-only text is left untouched."""
    folded = col
    for source, target in FOLD_MANY.items():
        folded = F.replace(folded, F.lit(source), F.lit(target))
    folded = F.translate(folded, _FOLD_FROM, _FOLD_TO)
    return F.when(F.length(col) == F.octet_length(col), col).otherwise(folded)


def _once(value: Column, use) -> Column:
    """``use`` of ``value``, worked out once however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _word_lines(col: Column) -> Column:
    """The words of a text joined by line ends, which no word holds; words over 255 characters are cut.

    One text instead of an array lets the later steps pass over all words at once.
    """
    cut = lambda j: F.when(
        j.rlike(rf"[^\n]{{{MAX_TOKEN_CHARS + 1}}}"), F.regexp_replace(j, rf"([^\n]{{{MAX_TOKEN_CHARS}}})(?=[^\n])", "$1\n")
    ).otherwise(j)
    return _once(F.array_join(F.regexp_extract_all(col, F.lit(_WORD), F.lit(0)), "\n"), cut)


def _lines(joined: Column) -> Column:
    return F.filter(F.split(joined, "\n"), lambda t: t != "")


def tokenize(col: Column) -> Column:
    """Unicode words of a text, in order; words over 255 characters are cut into pieces."""
    return _lines(_word_lines(col))


def fold_tokens(tokens: Column) -> Column:
    """Lower-cased, folded tokens: one pass over the joined tokens, none of which holds a line end.

    Folding follows tokenising, so a letter that folds to several stays one token.
    """
    return _lines(_once(F.lower(F.array_join(tokens, "\n")), ascii_fold))


def drop_possessive(tokens: Column) -> Column:
    """Remove a final ``'s`` from each (lower-cased, folded) token."""
    return F.transform(
        tokens,
        lambda t: F.when(t.endswith("'s"), F.substring(t, F.lit(1), F.length(t) - 2)).otherwise(t),
    )


def drop_stop_words(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(*STOP_WORDS))


def _stems(words: list[str], memo: dict[str, str]) -> pa.Array:
    """Stems of distinct words; ``memo`` is cut before it outgrows its bound, so a task's memory does not grow with its rows."""
    stems = []
    for word in words:
        stem = memo.get(word)
        if stem is None:
            stem = stem_word(word)
            if len(word) <= STEM_MEMO_CHARS:
                if len(memo) >= STEM_MEMO:
                    memo.clear()
                memo[word] = stem
        stems.append(stem)
    return pa.array(stems, pa.string())


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Porter stems of token lists; a task stems each distinct token once (its memo is bounded)."""
    memo: dict[str, str] = {}
    for tokens in batches:
        coded = tokens.flatten().dictionary_encode()
        stems = _stems(coded.dictionary.to_pylist(), memo)
        lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        offsets = pa.array([0, *lengths.cumsum().tolist()], pa.int32())
        yield pa.ListArray.from_arrays(offsets, stems.take(coded.indices), mask=tokens.is_null())


COUNTS_DDL = "struct<dl:int,terms:array<struct<term:string,tf:int,head:boolean>>>"


def _counter(stemmed: bool):
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo: dict[str, str] = {}
        for tokens in batches:
            coded = tokens.flatten().dictionary_encode()
            terms, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
            if stemmed:
                stems = _stems(terms.to_pylist(), memo).dictionary_encode()
                terms, codes = stems.dictionary, stems.indices.to_numpy().astype(np.int64)[codes]
            lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.repeat(np.arange(len(lengths)), lengths)
            width = max(len(terms), 1)
            cells, first, counts = np.unique(rows * width + codes, return_index=True, return_counts=True)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.zeros(0, np.int64)
            owners = cells // width
            found = pa.StructArray.from_arrays(
                [terms.take(pa.array(cells % width)), pa.array(counts.astype(np.int32)), pa.array(first == starts[owners])],
                ["term", "tf", "head"],
            )
            offsets = np.searchsorted(owners, np.arange(len(lengths) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), found)
            yield pa.StructArray.from_arrays([pa.array(lengths.astype(np.int32)), lists], ["dl", "terms"])

    return count


def term_counts(tokens: Column, stemmed: bool) -> Column:
    """Distinct tokens (or their Porter stems) of each token list with their counts, and the list's length.

    Counting here, while the list is at hand, spares an aggregation of one row per token.  ``head`` marks
    the first token's.
    """
    return F.arrow_udf(_counter(stemmed), COUNTS_DDL)(tokens)


def analyze(col: Column, option: str = "english_stem") -> Column:
    """Token array of a text column under one of the three analyser options."""
    if option not in ANALYZER_OPTIONS:
        raise ValueError(f"unknown analyzer option: {option}")
    tokens = words(col, option)
    return stem_tokens(tokens) if option == "english_stem" else tokens


def words(col: Column, option: str) -> Column:
    """Token array before stemming.

    Everything up to the split works on one joined text, and each step reads the one before it once.
    """
    folded = _once(F.lower(_word_lines(F.coalesce(col, F.lit("")))), ascii_fold)
    if option == "english_stem":
        folded = _once(folded, lambda j: F.when(j.contains("'s"), F.regexp_replace(j, r"'s(?=\n|\z)", "")).otherwise(j))
    tokens = F.split(folded, "\n")
    if option == "standard":
        return F.filter(tokens, lambda t: t != "")
    return F.filter(tokens, lambda t: ~t.isin("", *STOP_WORDS))


def raw_keyword(col: Column, ignore_above: int = 512) -> Column:
    """Exact-match companion of a text value; values over ``ignore_above`` characters have none."""
    return F.when(F.length(col) <= ignore_above, col)


def truncate(col: Column, n: int) -> Column:
    """First ``n`` code points."""
    return F.substring(col, 1, n)
