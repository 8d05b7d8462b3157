"""Fuzzy term expansion: query terms to vocabulary terms within AUTO edit distance.

Near pairs are found by equality on spelling keys and then verified.  The keys of the vocabulary (a few
for each character of a term) are a table of the index, written once; a search makes keys for its own
terms only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.edits import DELETION_MAX, allowed_edits, half_keys, half_probes, segment_probes, segments, variants
from marquee.operators.dedup import top_n
from marquee.session import materialise, sent_if_few

_PARTS = 3


def spelling_keys(terms: DataFrame) -> DataFrame:
    """``(size, key, term)`` of each term of ``terms``: keys of halves for short terms, of pieces for long ones."""
    n = F.length("term")
    rows = terms.select("term").where(n > 0)
    short = half_keys(rows.where(n <= DELETION_MAX)).select("size", "key", "term")
    long = rows.where(n > DELETION_MAX).select(n.alias("size"), F.explode(segments(F.col("term"), _PARTS)).alias("piece"), "term")
    return short.union(long.select("size", F.xxhash64("piece").alias("key"), "term"))


def _query_keys(forms: DataFrame) -> DataFrame:
    """``forms`` once per key of a term that they may reach with ``budget`` plain edits."""
    m = F.length("form")
    short = half_probes(forms).select(*forms.columns, "key")
    long = forms.where(m + F.col("budget") > DELETION_MAX)
    pieces = long.select(*forms.columns, F.explode(segment_probes(F.col("form"), _PARTS)).alias("piece"))
    return short.union(pieces.withColumn("piece", F.xxhash64("piece"))).distinct()


def near_terms(query_terms: DataFrame, vocabulary: DataFrame, prefix_length: int = 0) -> DataFrame:
    """``(query_term, term, edits)`` for every vocabulary term within the allowance of a query term.

    ``vocabulary`` is a table of spelling keys, or of bare terms, which then get their keys here.  Swaps
    are spelt out on the query side, so one plain (and JVM-side) edit distance per candidate decides; a
    hash collision fails that test like any other candidate.
    """
    terms = query_terms.select(F.col("term").alias("query_term")).distinct()
    terms = terms.withColumn("allowed", allowed_edits(F.col("query_term")))
    forms = terms.select("query_term", "allowed", F.explode(variants(F.col("query_term"), F.col("allowed"))).alias("v"))
    forms = forms.select("query_term", "v.form", "v.cost", (F.col("allowed") - F.col("v.cost")).alias("budget"))
    # Stored, so that its size is known before the join.
    keys = materialise(_query_keys(forms), "query-keys")
    if "key" not in vocabulary.columns:
        vocabulary = spelling_keys(vocabulary.select("term").distinct())
    # Sizes that no query term can reach are not read (there are at most 255 sizes).
    reach = terms.select(F.explode(F.sequence(F.length("query_term") - F.col("allowed"), F.length("query_term") + F.col("allowed"))).alias("n"))
    vocabulary = vocabulary.where(F.col("size").isin([r["n"] for r in reach.distinct().collect()]))
    if prefix_length:
        keys = keys.withColumn("prefix", F.substring("query_term", 1, prefix_length))
        vocabulary = vocabulary.withColumn("prefix", F.substring("term", 1, prefix_length))
    pairs = vocabulary.join(sent_if_few(keys), ["key", "prefix"] if prefix_length else ["key"])
    plain = F.when(F.col("budget") == 2, F.levenshtein("form", "term", 2)).otherwise(F.levenshtein("form", "term", 1))
    pairs = pairs.withColumn("plain", F.when(F.col("form") == F.col("term"), 0).otherwise(plain))
    pairs = pairs.where(F.col("plain").between(0, F.col("budget")))
    return pairs.groupBy("query_term", "term").agg(F.min(F.col("cost") + F.col("plain")).alias("edits"))


def expand_terms(
    query_terms: DataFrame,
    term_stats: DataFrame,
    max_expansions: int | None = None,
    prefix_length: int = 0,
    spelling: DataFrame | None = None,
) -> DataFrame:
    """``(field, query_term, term, df, edits, similarity, df_used)`` per field of ``term_stats``.

    ``spelling`` are the spelling keys of an index; without them, keys are made of all terms.  All near terms are kept, or of each query term and field the nearest ``max_expansions`` (order: edits,
    term).  ``similarity`` is 1 - edits / shorter length; ``df_used`` is the largest
    document frequency among the kept terms, so that a rare misspelling does not outscore the word.
    """
    near = materialise(near_terms(query_terms, term_stats if spelling is None else spelling, prefix_length), "near")
    found = term_stats.join(near, "term")
    group = ["field", "query_term"]
    if max_expansions:
        found = top_n(found, group, [F.col("edits"), F.col("term")], max_expansions).drop("rank")
        found = found.withColumn("df_used", F.max("df").over(Window.partitionBy(*group)))
    else:
        found = found.join(found.groupBy(*group).agg(F.max("df").alias("df_used")), group)
    shorter = F.least(F.length("query_term"), F.length("term"))
    return found.select(
        "field",
        "query_term",
        "term",
        "df",
        "edits",
        (1.0 - F.col("edits") / shorter).alias("similarity"),
        "df_used",
    )
