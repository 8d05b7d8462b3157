"""Mixing sources to target weights by fitting word budgets exactly.

Sizes are counted once.  Each source gets a target by weight, capped at a multiple of its size; whole
repeats fill most of it.  What is left is a subset-sum problem over the source's histogram of lengths: a
proportional cut leaves a small remainder, and bounded-knapsack dynamic programming over the lengths not
used yet closes it.  Documents of a length are then taken in the order of a seeded hash.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import ROW, numbered, word_array
from marquee.session import materialise, scratch_scope, sent_if_few

# Weights of the sources in order, the total against all sizes, and the cap of a source.
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
CAP = 2
SEED = 20_24
# Ranges of the seeded hash within a length; a length that most documents have is ranked range by range.
RANGES = 4096


def word_count(text: Column) -> Column:
    """Words of a text; 0 for a null."""
    return F.size(word_array(text)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT, cap: int = CAP) -> DataFrame:
    """``sizes (source, source_size, ...)``, one row per source, with ``target``.

    Sources in code-point order, null last, take the weights in turn and share ``percent`` of all words by
    weight.  A target above ``cap`` times its source is cut and the excess goes to the others by weight,
    again and again: that ends where target = min(cap x size, level x weight) and all words are given out.
    Sorted by the level at which each is cut, running sums give that level at once.  If all are cut there
    is nothing left to take.  One row per source goes through one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    weighed = sizes.withColumn("w", turn).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    earlier, later = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * percent / 100.0
    level = (F.col("budget") - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / F.sum("w").over(later)
    found = weighed.withColumn("budget", budget).withColumn("level", level)
    # The first source that is not cut at its own level sets the level for it and all after it (theirs
    # are no higher).
    open_level = F.max(F.when(F.col("level") * F.col("w") <= F.col("most"), F.col("level"))).over(everything)
    cut = F.when(F.col("open").isNull(), F.col("most")).otherwise(F.least("most", F.col("open") * F.col("w")))
    return found.withColumn("open", open_level).select(*sizes.columns, cut.alias("target"))


def choose_lengths(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length to take so that their words come closest to ``budget``.

    The same share of every length first, rounded by a running sum, which leaves less than a few of the
    longest documents.  Then some of those are given back until the rest fits the table of sums, and
    the table (reachable sums as the bits of one integer, a step for each group of 1, 2, 4, ... documents)
    finds the best remainder, which is walked back.
    """
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    if budget <= 0 or not total:
        return [0] * len(lengths)
    if budget >= total:
        return list(counts)
    taken, run, given = [], 0, 0
    for n, c in zip(lengths, counts, strict=True):
        run += n * c
        want = run * budget // total - given
        take = min(c, max(0, want // n)) if n else 0
        taken.append(take)
        given += take * n
    left = budget - given
    # Make room: a remainder smaller than the shortest free document can only be closed by an exchange.
    room = 2 * max(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        while left < room and taken[i]:
            taken[i] -= 1
            left += lengths[i]
        if left >= room:
            break
    mask = (1 << (left + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    reach = 1
    for i in sorted(range(len(lengths)), key=lambda i: lengths[i]):
        free = min(counts[i] - taken[i], left // lengths[i] if lengths[i] else 0)
        group = 1
        while free > 0 and not reach >> left & 1:
            size = min(group, free)
            steps.append((i, size, reach))
            reach = (reach | reach << (size * lengths[i])) & mask
            free -= size
            group *= 2
        if reach >> left & 1:
            break
    best = reach.bit_length() - 1
    for i, size, before in reversed(steps):
        if not before >> best & 1:
            taken[i] += size
            best -= size * lengths[i]
    return taken


def _plan(groups: pd.DataFrame) -> pd.DataFrame:
    """Documents of each length to take beyond the whole repeats, for one source's histogram."""
    groups = groups.sort_values("size")
    words = int((groups["size"] * groups["docs"]).sum())
    target = float(groups["target"].iloc[0])
    repeats = int(target // words) if words else 0
    extra = choose_lengths(groups["size"].tolist(), groups["docs"].tolist(), round(target) - repeats * words)
    return groups[["sid", "size"]].assign(repeats=repeats, extra=extra)


def _sized(docs: DataFrame, text: str, source: str, key: str, seed: int) -> list[Column]:
    """Source id, size, seeded hash and its range of each row."""
    h = F.xxhash64(F.lit(seed), F.col(key).cast("string"), F.col(text))
    return [
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("none")).alias("sid"), word_count(F.col(text)).alias("size"),
        h.alias("h"), F.pmod(h, F.lit(RANGES)).alias("range"),
    ]


def _cut(sized: DataFrame, weights: tuple[int, ...], percent: int, cap: int) -> tuple[DataFrame, DataFrame]:
    """From ``sized (sid, source, size, range)``: ``(sid, size, range, docs, repeats, extra, some)`` and each source's target.

    ``some`` is how many documents of a range the cut takes beyond whole repeats: all, none, or some of the
    range that it falls into.
    """
    ranges = materialise(sized.groupBy("sid", "source", "size", "range").agg(F.count("*").alias("docs")), "ranges")
    lengths = ranges.groupBy("sid", "source", "size").agg(F.sum("docs").alias("docs"))
    totals = lengths.groupBy("sid", "source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    goals = materialise(targets(totals, weights, percent, cap).drop("source"), "targets")
    wanted = lengths.drop("source").join(goals, "sid").groupBy("sid").applyInPandas(_plan, "sid string, size long, repeats int, extra long")
    before = Window.partitionBy("sid", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    some = F.col("extra") - F.coalesce(F.sum("docs").over(before), F.lit(0))
    cut = ranges.drop("source").join(wanted, ["sid", "size"]).withColumn("some", F.least("docs", F.greatest(F.lit(0), some)))
    return cut, goals


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", carry: list[str] | None = None,
        weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """``_carry`` (a struct of the columns named), ``size``, ``source_size``, ``target`` and ``times`` of every row.

    ``times`` is how often the mix takes the row: the whole repeats of its source, or one more.  Words per
    source meet the source's target to the word where its lengths allow.  Null and empty texts have size 0
    and only follow whole repeats; a null source is a source of its own; repeated rows are ranked like any
    others; an empty table has no rows.  Reruns agree: the order is a hash of seed, key and text.  No group
    of rows is gathered: one source's histogram (a row per length) goes to one task, documents are ranked
    in ranges of their hash.
    """
    carry = [key] if carry is None else carry
    sized = materialise(docs.select(F.struct(*carry).alias("_carry"), F.col(source).alias("source"), *_sized(docs, text, source, key, seed)), "sizes")
    cut, goals = _cut(sized, weights, percent, cap)
    rows = sized.drop("source").join(cut.join(goals, "sid"), ["sid", "size", "range"])
    rank = F.row_number().over(Window.partitionBy("sid", "size", "range").orderBy("h", F.col("_carry").getField(carry[0])))
    more = F.when(F.col("some") == 0, 0).when(F.col("some") == F.col("docs"), 1).otherwise((rank <= F.col("some")).cast("int"))
    return rows.select("_carry", "size", "source_size", "target", (F.col("repeats") + more).cast("int").alias("times"))


def cut_lines(sized: DataFrame, weights: tuple[int, ...], percent: int, cap: int) -> DataFrame:
    """``(sid, size, repeats, line)``: rows up to ``line`` (range, hash, name) of their length are taken once more.

    From stored ``sized (sid, source, size, range, h, <names of rows>)``.  One row per source and length;
    a null line takes none.  Rows are ranked only in the range that a cut falls into.
    """
    cut, _ = _cut(sized, weights, percent, cap)
    place = F.struct("range", "h", *ROW)
    inside = cut.where("some > 0 AND some < docs").select("sid", "size", "range", "some")
    rank = F.row_number().over(Window.partitionBy("sid", "size", "range").orderBy("h", *ROW))
    edges = sized.join(inside, ["sid", "size", "range"]).withColumn("rank", rank).where("rank = some").select("sid", "size", place.alias("edge"))
    end = F.lit((1 << 63) - 1)
    last = F.max(F.when(F.col("some") > 0, F.col("range")))
    whole = cut.groupBy("sid", "size").agg(F.any_value("repeats").alias("repeats"), last.alias("last")).join(edges, ["sid", "size"], "left")
    top = F.when(F.col("last").isNotNull(), F.struct(F.col("last").alias("range"), end.alias("h"), *[end.alias(c) for c in ROW]))
    return whole.select("sid", "size", "repeats", F.coalesce("edge", top).alias("line"))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights: tuple[int, ...] = WEIGHTS,
          percent: int = SHARE_PERCENT, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs`` with their columns, each as often as it is taken.

    Nulls, ties and empty tables as in ``mix``.  Texts stay where they are read: what goes to them is where
    the cut lies in each length of each source.
    """
    rows = numbered(docs)
    with scratch_scope(docs.sparkSession) as scope:
        own = _sized(rows, text, source, key, seed)
        sized = materialise(rows.select(*ROW, F.col(source).alias("source"), *own), "sizes")
        lines = scope.keep(materialise(cut_lines(sized, weights, percent, cap), "lines"))
    names = [f"_{c}" for c in ("sid", "size", "h", "range")]
    lines = lines.select(F.col("sid").alias("_sid"), F.col("size").alias("_size"), "repeats", "line")
    told = rows.select(F.struct(*docs.columns).alias("_doc"), *ROW, *[c.alias(n) for c, n in zip(own, names, strict=True)])
    told = told.join(sent_if_few(lines), ["_sid", "_size"])
    place = F.struct(F.col("_range").alias("range"), F.col("_h").alias("h"), *ROW)
    times = F.col("repeats") + F.coalesce((place <= F.col("line")).cast("int"), F.lit(0))
    repeated = told.select("_doc", F.explode(F.array_repeat(F.lit(0), times)))
    return repeated.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])
