"""How filters overlap: what each removes in every order of application.

Every filter is evaluated once per document and leaves one bit.  Four bits come from the text alone; the
fifth says that a smaller key has the same text.  For that, counting-Bloom sketches are merged first: a
text that owns a cell is unique for certain.  Only the others are shuffled, whole, for the smallest key of
each exact text.  Documents are then counted by part and mask, and every order is sums of those counts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import materialise

# The filters in the order of their bits.
FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")
SYMBOLS = b"#$%&*|"
# Cells of a sketch's page, pages by rows, and cells that a text counts in.
PAGE_CELLS = 1 << 16
CELLS_PER_ROW = 16
PROBES = 3
# Pages that are sent to all tasks (8 KB each); more of them are joined by shuffle.
MOST_PAGES_SENT = 4_096

_CAPITALS = bytes(range(65, 91))
_INNER_BYTES = bytes(range(0x80, 0xC0))


def text_mask(data: bytes) -> int:
    """Bits of the four filters that a text alone decides."""
    words = data.split()  # bytes: at 09-0D and 20, as words are defined
    points = len(data.translate(None, _INNER_BYTES))
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    fails = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * capitals > 2 * points,
        len(data.translate(None, SYMBOLS)) < len(data),
    )
    return sum(1 << bit for bit, failed in enumerate(fails) if failed)


def _hashed(text: str) -> list[Column]:
    """Two independent hashes of a text: ``h`` names its page, ``g`` its cells; together they name the text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(whole).alias("h"), F.xxhash64(F.lit(7), whole).alias("g")]


def measure(docs: DataFrame, text: str = "text", part: str = "source", key: str = "doc_id") -> DataFrame:
    """Stored ``(doc_id, part, h, g, mask)`` of every row, ``mask`` without the bit for repeats."""
    rows = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), *_hashed(text),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_t"),
    )
    schema = rows.select("doc_id", "part", "h", "g", F.lit(0).alias("mask")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = pa.array([text_mask(t.as_py()) for t in batch.column(4)], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], masks], names=schema.names)

    return materialise(rows.mapInArrow(run, schema), "flags")


def _page(pages: int) -> Column:
    return F.pmod("h", F.lit(pages)).alias("page")


def _cell(probe: int) -> Column:
    return F.shiftrightunsigned("g", 16 * probe).bitwiseAND(F.lit(PAGE_CELLS - 1))


def sketch(flags: DataFrame, pages: int) -> DataFrame:
    """Stored ``(page, bits)``: the cells of a merged counting-Bloom sketch that were hit twice or more.

    Counters stop at two, that is all that is asked of them.  Each batch sends its own small sketch of a
    page (cells hit once, cells hit more), so a text that a third of the rows share arrives as three cells
    a batch.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, g = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            cells = np.concatenate([page * PAGE_CELLS + ((g >> np.uint64(16 * p)) & np.uint64(PAGE_CELLS - 1)).astype(np.int64) for p in range(PROBES)])
            cells, hits = np.unique(cells, return_counts=True)
            own, first = np.unique(cells // PAGE_CELLS, return_index=True)
            hit = np.split((cells % PAGE_CELLS).astype(np.uint16), first[1:])
            more = np.split(hits > 1, first[1:])
            yield pa.RecordBatch.from_arrays([
                pa.array(own, pa.int64()),
                pa.array([c[~m].tobytes() for c, m in zip(hit, more, strict=True)], pa.binary()),
                pa.array([c[m].tobytes() for c, m in zip(hit, more, strict=True)], pa.binary()),
            ], names=["page", "once", "more"])

    def merge(page: pa.Table) -> pa.Table:
        hits = np.zeros(PAGE_CELLS, np.int64)
        for once, more in zip(page["once"], page["more"], strict=True):
            hits[np.frombuffer(once.as_py(), np.uint16)] += 1
            hits[np.frombuffer(more.as_py(), np.uint16)] += 2
        bits = np.packbits(hits > 1, bitorder="little").view(np.int64)
        return pa.table({"page": page["page"].slice(0, 1), "bits": pa.array([bits], pa.list_(pa.int64()))})

    parts = flags.select(_page(pages), "g").mapInArrow(partial, "page long, once binary, more binary")
    return materialise(parts.groupBy("page").applyInArrow(merge, "page long, bits array<long>"), "sketch")


def sketch_pages(rows: int) -> int:
    return max(1, -(-rows * CELLS_PER_ROW // PAGE_CELLS))


def _with_bits(rows: DataFrame, cells: DataFrame, pages: int) -> DataFrame:
    """``rows (h, g, ...)`` with ``possible``: no cell says that the row's text is unique."""
    hit = [F.getbit(F.get("bits", F.shiftright(_cell(p), 6).cast("int")), _cell(p).bitwiseAND(F.lit(63)).cast("int")) == 1 for p in range(PROBES)]
    possible = hit[0]
    for h in hit[1:]:
        possible = possible & h
    sent = F.broadcast(cells) if pages <= MOST_PAGES_SENT else cells
    return rows.withColumn("page", _page(pages)).join(sent, "page").withColumn("possible", possible).drop("page", "bits")


def first_keys(docs: DataFrame, cells: DataFrame, pages: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Stored ``(doc_id, h, g)``: the smallest key of each exact text that may repeat.

    Rows with equal texts meet after each task has kept one row of each text.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"), *_hashed(text))
    likely = _with_bits(rows, cells, pages).where("possible")
    heads = likely.groupBy("_t").agg(F.min("doc_id").alias("doc_id"), F.any_value("h").alias("h"), F.any_value("g").alias("g"))
    return materialise(heads.where("doc_id IS NOT NULL").drop("_t"), "heads")


def masks(docs: DataFrame, text: str = "text", part: str = "source", key: str = "doc_id") -> DataFrame:
    """``(doc_id, part, mask)`` of every row, all five bits set where the filter fails.

    A null text is empty and equal to other empty texts.  Rows that repeat a key with its text fail
    the last filter only if a smaller key has that text.  A null key is neither smaller nor larger than
    another and never fails it.
    """
    flags = measure(docs, text, part, key)
    pages = sketch_pages(flags.count())
    cells = sketch(flags, pages)
    heads = first_keys(docs, cells, pages, text, key).withColumn("head", F.lit(True))
    rows = _with_bits(flags, cells, pages).join(heads, ["doc_id", "h", "g"], "left")
    repeated = F.col("possible") & F.col("doc_id").isNotNull() & F.col("head").isNull()
    return rows.select("doc_id", "part", (F.col("mask") + F.when(repeated, REPEATED).otherwise(0)).alias("mask"))


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, docs, good, toxic)``; a document is good or toxic if any of its labels says so."""
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    return rows.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("docs"), F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic"),
    )


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; all figures are sums of ``mask_counts``.

    ``shapley`` sums what the filter removes over all orders: of the orders, a document with n failing
    filters is removed by each of them in one of n.  A part has one row per mask, 32 at most.
    """
    own = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("m"))
    orders = ["".join(p) for p in itertools.permutations(FILTERS)]
    rows = own.select("part", "m", F.explode(F.array(*[F.lit(o) for o in orders])).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit = lambda i: F.call_function("shiftleft", F.lit(1), F.instr(F.lit(FILTERS), F.col("filter_order").substr(i, F.lit(1))) - 1)
    before = F.lit(0)
    for i in range(1, len(FILTERS)):
        before = before + F.when(F.col("step") > i, bit(F.lit(i))).otherwise(0)
    rows = rows.select("*", bit(F.col("step")).alias("own"), before.alias("before"))

    def total(field: str, keep, scale=lambda m: F.lit(1)) -> Column:
        add = lambda acc, c: acc + F.when(keep(c["mask"]), c[field] * scale(c["mask"])).otherwise(0)
        return F.aggregate("m", F.lit(0).cast("long"), add)

    fails = lambda m: m.bitwiseAND(F.col("own")) != 0
    gone = lambda m: m.bitwiseAND(F.col("before")) != 0
    ways = lambda m: F.lit(len(orders)).cast("long") / F.bit_count(m)
    return rows.select(
        "part", "filter_order", "step",
        total("docs", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total("docs", lambda m: fails(m) & ~gone(m)).alias("removed"),
        total("docs", lambda m: fails(m) & gone(m)).alias("redundant"),
        total("docs", lambda m: m == F.col("own")).alias("unique_fails"),
        total("good", lambda m: fails(m) & ~gone(m)).alias("good_lost"),
        total("toxic", lambda m: fails(m) & ~gone(m)).alias("toxic_lost"),
        total("docs", fails, lambda m: ways(m).cast("long")).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "source", key: str = "doc_id") -> DataFrame:
    """The audit of ``docs`` with ``labels (doc_id, quality, toxic)``.

    Null and empty texts fail the first filter only (and the last, if a smaller key is empty too).  Very
    long texts are measured whole, one at a time.  Null parts count as the empty one; other columns are
    not read.  An empty table has no parts and gives no rows; a document without labels, or
    with a null key, is neither good nor toxic.
    """
    rows = masks(docs, text, part, key)
    return audit(mask_counts(rows, labels.select(F.col(key).alias("doc_id"), "quality", "toxic")))
