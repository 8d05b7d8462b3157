"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and one bit per failed
rule; a policy is a versioned set of bits, applied later without reading a text again, and ablations
(what would be kept without one rule) are bitwise sums over the ledger.  DataFrame functions only; no
shuffle but for the sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import SPACE_CHARS, WORD, word_array

WINDOW = 5

# Rule name -> failure, over the measurements.  A rule's place is its bit; append, never reorder.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "capitals": "2 * n_capitals > word_chars",
}
# Policy version -> rules whose failure rejects a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("few_words", "repeated_words"),
    "v2": tuple(RULES),
}
DEFAULT_POLICY = "v2"
BASE_POLICY = "v1"


def mask_of(policy: str | tuple[str, ...]) -> int:
    """Bits of a policy version, or of a tuple of rule names."""
    names = POLICIES[policy] if isinstance(policy, str) else policy
    return sum(1 << list(RULES).index(name) for name in names)


def _outside(text: Column, chars: str) -> Column:
    """Code points of ``text`` that are not in ``chars``."""
    return F.length(F.translate(text, chars, "")).cast("long")


def measure(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id`` and the measurements of each whole text.

    * ``n_words`` words, ``word_chars`` code points in them, ``n_symbols`` characters of ``#*$%&|<>``
    * ``n_lines`` lines with a word, ``n_dup_lines`` those equal to an earlier line
    * ``n_repeat_words`` words inside five-word windows that occur twice or more in the text
    * ``n_capitals`` letters A-Z

    A null or empty text measures zero everywhere.  Rows do not affect one another: repeated rows and
    repeated or null keys each give a row.  Other columns of ``docs`` are not read, whatever their names.

    Columns are built in steps so that each array is made once; inside a lambda it is only read.
    """
    t = F.col("_t")
    split = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_t")).select(
        "doc_id",
        F.transform(word_array(t), lambda w: F.xxhash64(w)).alias("_w"),
        F.filter(F.split(t, "\n"), lambda line: line.rlike(WORD)).alias("_lines"),
        _outside(t, SPACE_CHARS).alias("word_chars"),
        (F.length(t) - _outside(t, "#*$%&|<>")).cast("long").alias("n_symbols"),
        (F.length(t) - _outside(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_capitals"),
    )
    n = F.size("_w")
    counted = split.select(
        "doc_id", n.cast("long").alias("n_words"), "word_chars", "n_symbols", "n_capitals",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, F.transform(
            F.slice("_w", F.lit(1), n - WINDOW + 1),
            lambda w, i: F.xxhash64(w, *[F.get("_w", i + k) for k in range(1, WINDOW)]),
        )).alias("_windows"),
    )
    kept = [c for c in counted.columns if c != "_windows"]
    # Only texts with a repeated window are sorted: equal windows become neighbours there.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.array_sort(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    ordered = counted.select(*kept, F.when(repeats, pairs).alias("_sorted"))
    equal = lambda x, i: F.coalesce(F.get("_sorted", i)["w"] == x["w"], F.lit(False))
    marked = F.transform("_sorted", lambda x, i: F.when(equal(x, i - 1) | equal(x, i + 1), x["i"]))
    placed = ordered.select(*kept, F.array_sort(F.filter(marked, lambda p: p.isNotNull())).alias("_places"))
    # A repeated window covers five words, or as many as there are before the next repeated one.
    spans = F.transform("_places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", i + 1) - p, F.lit(WINDOW))))
    total = F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x)
    return placed.select(*kept, F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"))


def ledger(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Measurements and ``fail_bits``: bit i is set when rule i fails.

    Store it before rows are filtered by it: a filter would be moved below the measurements, which would
    then be worked out again for every use.
    """
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())]
    total = bits[0].cast("long")
    for bit in bits[1:]:
        total = total.bitwiseOR(bit.cast("long"))
    return measure(docs, text, key).withColumn("fail_bits", total)


def apply_policy(book: DataFrame, policy: str | tuple[str, ...] = DEFAULT_POLICY) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return book.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy))) == 0)


def ablations(book: DataFrame, policy: str | tuple[str, ...] = DEFAULT_POLICY) -> DataFrame:
    """One row per rule of the policy: documents that fail it, and those that fail no other rule.

    ``n_only`` is what the policy would keep in addition if the rule were left out.  An empty ledger
    counts zero.
    """
    mask = mask_of(policy)
    names = [name for name in RULES if mask_of((name,)) & mask]
    failed = F.col("fail_bits").bitwiseAND(F.lit(mask))
    sums = []
    for name in names:
        bit = mask_of((name,))
        sums.append(F.coalesce(F.sum((failed.bitwiseAND(F.lit(bit)) != 0).cast("long")), F.lit(0)).alias(f"f_{name}"))
        sums.append(F.coalesce(F.sum((failed == bit).cast("long")), F.lit(0)).alias(f"o_{name}"))
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"f_{n}").alias("n_failed"), F.col(f"o_{n}").alias("n_only")) for n in names])
    return book.agg(*sums).select(F.explode(rows).alias("r")).select("r.*")
