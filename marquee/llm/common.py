"""What the operators of this package share: words, folds, blocks of texts, components of a graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialise

# The separators of words, and the pattern of a word.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

BLOCK_BYTES = 1 << 20
# What names a row of a stored table: a hash of its file's path, and its place in the file.
ROW = ["_file", "_at"]


def word_array(text: Column) -> Column:
    """Words of a text in order; an empty array for a null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key written as text, modulo ``folds``; a null key counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """``(first row, texts as UTF-8)`` of consecutive rows holding about ``limit`` bytes; a null is empty.

    A longer text is a block of its own, so memory follows the longest text and not the batch.
    """
    block: list[bytes] = []
    size = first = 0
    for row, value in enumerate(texts):
        data = value.as_py()
        data = b"" if data is None else data.encode("utf-8", "surrogatepass")
        if block and size + len(data) > limit:
            yield first, block
            block, size, first = [], 0, row
        block.append(data)
        size += len(data)
    if block:
        yield first, block


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (wraps on purpose)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``ROW``, the same for a row however often it is read.

    A stored table is read as it is; anything else is stored first.  What is found about rows can then be
    kept without their texts and be joined back.
    """
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() == "Project":
        plan = plan.children().head()
    stored = docs if plan.nodeName() == "LogicalRelation" and docs.inputFiles() else materialise(docs, "numbered")
    return stored.select("*", F.xxhash64("_metadata.file_path").alias(ROW[0]), F.col("_metadata.row_index").alias(ROW[1]))


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` of every id in ``edges (a, b)``: the smallest id reachable.

    Alternating stars: each round hangs larger neighbours on the smallest one, then smaller ones.
    Minima are combined before the shuffle and the edge list never grows, so a hub with a third of all
    edges costs no more than they do.  Every round is a table in the shared folder; the loop ends when
    the edges stay the same.  Ids that are null are ignored.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    start = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(high, low).distinct()
    stars = materialise(start, name)
    mark = _fingerprint(stars)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        stars = materialise(_round(stars), name)
        before, mark = mark, _fingerprint(stars)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = stars.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return members.union(stars.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _round(stars: DataFrame) -> DataFrame:
    """Larger neighbours hung on the smallest one, then smaller ones."""
    both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").select(F.explode(F.array(
        F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
    )).alias("e")).select("e.a", "e.b")
    return small.where("a <> b").distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and order-free hashes of an edge list."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(7)))).first()
    return tuple(row)


def ranked(df: DataFrame, order: list[Column], name: str = "ranked") -> DataFrame:
    """``df`` with ``rank``: 1, 2, 3, ... in ``order`` over all rows, which no task sees together.

    Rows are laid out in ranges of the order and numbered within them, after as many as earlier ranges hold.
    End ``order`` with a column that is unique, else rows that compare as equal stay in one range.
    """
    placed = materialise(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range goes through one task.
    starts = placed.groupBy("_range").agg(F.count("*").alias("n")).select("_range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return placed.withColumn("rank", own).join(starts, "_range").withColumn("rank", F.col("rank") + F.col("_start")).drop("_range", "_start")
