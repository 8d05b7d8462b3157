"""Edit distance with adjacent swaps, and the signatures that find near terms by equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Terms up to this length are matched by keys of their halves, longer ones by segments.
DELETION_MAX = 16


def allowed_edits(term: Column) -> Column:
    """AUTO fuzziness: up to 2 characters exact, 3 to 5 one edit, longer two."""
    n = F.length(term)
    return F.when(n <= 2, 0).when(n <= 5, 1).otherwise(2)


def _positions(term: Column, last: Column) -> Column:
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def swaps(term: Column) -> Column:
    """All strings one adjacent swap away."""
    n = F.length(term)
    return F.transform(
        _positions(term, n - 1),
        lambda i: F.concat(
            F.substring(term, F.lit(1), i - 1),
            F.substring(term, i + 1, F.lit(1)),
            F.substring(term, i, F.lit(1)),
            F.substring(term, i + 2, n),
        ),
    )


def skip_swaps(term: Column) -> Column:
    """All strings made by dropping a character and swapping its two neighbours."""
    n = F.length(term)
    return F.transform(
        _positions(term, n - 2),
        lambda i: F.concat(
            F.substring(term, F.lit(1), i - 1),
            F.substring(term, i + 2, F.lit(1)),
            F.substring(term, i, F.lit(1)),
            F.substring(term, i + 3, n),
        ),
    )


def variants(term: Column, edits: Column) -> Column:
    """Forms of a query term with the swaps already made, as (form, cost) structs.

    With swaps counted as one edit, the distance of two terms within two edits is the smallest
    cost + plain edit distance over the forms of one of them.
    """
    at = lambda forms, cost: F.transform(F.array_distinct(forms), lambda f: F.struct(f.alias("form"), F.lit(cost).alias("cost")))
    one = swaps(term)
    two = F.concat(F.flatten(F.transform(one, swaps)), skip_swaps(term))
    own = at(F.array(term), 0)
    return F.when(edits == 0, own).when(edits == 1, F.concat(own, at(one, 1))).otherwise(
        F.concat(own, at(one, 1), at(two, 2))
    )


def _left_out(text: Column, i: Column) -> Column:
    """``text`` without its ``i``-th character; all of it for 0."""
    return F.when(i == 0, text).otherwise(F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))


def half_keys(terms: DataFrame, term: str = "term") -> DataFrame:
    """Each term once per way to leave out at most one character of one of its halves: adds ``size, key``.

    Of two edits one half takes one at most, so a near text has a prefix or suffix that shares a key with
    that half.  Terms under four characters are never two edits away and keep their halves whole.
    Positions are exploded rather than handled inside array functions, so the string work is compiled.
    """
    n = F.length(term)
    rows = terms.select("*", n.alias("size"), F.explode(F.array(F.lit(0), F.lit(1))).alias("_side"))
    middle = F.floor(n / 2).cast("int")
    half = F.when(F.col("_side") == 0, F.substring(term, F.lit(1), middle)).otherwise(F.substring(term, middle + 1, n))
    rows = rows.withColumn("_half", half)
    rows = rows.withColumn("_i", F.explode(F.sequence(F.lit(0), F.when(n >= 4, F.length("_half")).otherwise(0))))
    key = F.xxhash64("size", "_side", _left_out(F.col("_half"), F.col("_i")))
    return rows.withColumn("key", key).drop("_side", "_half", "_i")


def half_probes(forms: DataFrame, form: str = "form", budget: str = "budget", longest: int = DELETION_MAX) -> DataFrame:
    """Keys of `half_keys` under which every term within ``budget`` plain edits of ``form`` is found: adds ``size, key``.

    A half that takes no edit begins or ends the form as it is; one that takes an edit is up to one
    character longer or shorter there.
    """
    m, b = F.length(form), F.col(budget)
    rows = forms.withColumn("size", F.explode(F.sequence(m - b, m + b))).where(F.col("size").between(1, longest))
    rows = rows.withColumn("_side", F.explode(F.array(F.lit(0), F.lit(1))))
    middle = F.floor(F.col("size") / 2).cast("int")
    spare = F.when(b > 1, 1).otherwise(0)
    rows = rows.withColumn("_own", F.when(F.col("_side") == 0, middle).otherwise(F.col("size") - middle))
    rows = rows.withColumn("_l", F.explode(F.sequence(F.col("_own") - spare, F.col("_own") + spare)))
    rows = rows.where(F.col("_l").between(0, m))
    piece = F.when(F.col("_side") == 0, F.substring(form, F.lit(1), F.col("_l"))).otherwise(F.substring(form, m - F.col("_l") + 1, F.col("_l")))
    rows = rows.withColumn("_piece", piece)
    rows = rows.withColumn("_i", F.explode(F.sequence(F.lit(0), F.when(b > 1, F.col("_l")).otherwise(0))))
    key = F.xxhash64("size", "_side", _left_out(F.col("_piece"), F.col("_i")))
    return rows.withColumn("key", key).drop("_side", "_own", "_l", "_piece", "_i")


def segments(term: Column, parts: int) -> Column:
    """``parts`` consecutive pieces of a term as key texts (length, index, piece).

    Each plain edit touches one piece, so of three pieces and two edits one survives, shifted by no
    more than two positions.
    """
    n = F.length(term)
    start = lambda i: F.floor(i * n / parts).cast("int")
    return F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)),
        lambda i: _piece_key(n, i, F.substring(term, start(i) + 1, start(i + 1) - start(i))),
    )


def _piece_key(length: Column, part: Column, piece: Column) -> Column:
    return F.concat_ws(":", length.cast("string"), part.cast("string"), piece)


def segment_probes(term: Column, parts: int, edits: int = 2) -> Column:
    """Pieces of ``term`` that could equal a piece of a term of nearby length, as `segments` keys."""
    n = F.length(term)
    start = lambda length, i: F.floor(i * length / parts).cast("int")
    shifts = F.array(*[F.lit(s) for s in range(-edits, edits + 1)])

    def probe(length: Column, i: Column, shift: Column) -> Column:
        first = start(length, i) + 1 + shift
        size = start(length, i + 1) - start(length, i)
        return F.when((first >= 1) & (first + size - 1 <= n), _piece_key(length, i, F.substring(term, first, size)))

    probes = F.flatten(
        F.flatten(
            F.transform(
                shifts,
                lambda d: F.transform(
                    F.sequence(F.lit(0), F.lit(parts - 1)),
                    lambda i: F.transform(shifts, lambda s: probe(n + d, i, s)),
                ),
            )
        )
    )
    return F.array_distinct(F.filter(probes, lambda p: p.isNotNull()))
