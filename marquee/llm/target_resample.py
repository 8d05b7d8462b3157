"""Resampling towards a target distribution by hashed n-gram importance weights.

Separators are collapsed to single spaces and a regular expression is run with overlaps: its lookarounds
let a match begin and end only at word bounds, so every run of words is a match by itself.  The CRC of
each match names a bucket.  Bucket counts of corpus and target give each bucket a gain, a document weighs
the mean gain of its features, and seeded Gumbel noise on the weights draws without replacement.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ranked
from marquee.session import materialise


@dataclass(frozen=True)
class Plan:
    """Longest run of words, buckets, seed of the noise, least words of a document drawn, and percent drawn."""

    words: int = 1
    buckets: int = 10_000
    seed: int = 2024
    least_words: int = 20
    percent: int = 10


# A byte is a separator (made a space), a capital (lower-cased) or itself; all bytes above 7F are letters.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_SPACES = re.compile(b" +")


def run_pattern(words: int) -> regex.Pattern:
    """Runs of so many words of a collapsed text, each at word bounds."""
    return regex.compile(rb"(?<![^ ])" + rb" ".join([rb"[^ ]++"] * words) + rb"(?![^ ])")


def bucket_list(data: bytes, patterns: list[regex.Pattern], buckets: int) -> tuple[int, np.ndarray]:
    """``(words, buckets of all features)`` of one text."""
    text = _SPACES.sub(b" ", data.translate(_FOLD))
    found = [np.fromiter((crc32(m.group()) % buckets for m in p.finditer(text, overlapped=True)), np.int64) for p in patterns]
    return len(found[0]), np.concatenate(found)


def features(docs: DataFrame, plan: Plan, text: str, key: str) -> DataFrame:
    """Stored ``(doc_id, row, n_words, n_features, buckets, counts)``: each row's buckets (packed) with their counts.

    Texts are scanned once, whole, one at a time; what follows reads only this.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_t"))
    zero = F.lit(0).cast("long")
    schema = rows.select("doc_id", "row", zero.alias("n_words"), zero.alias("n_features"), F.lit(b"").alias("buckets"), F.lit(b"").alias("counts")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [run_pattern(n + 1) for n in range(plan.words)]
        for batch in batches:
            out = []
            for t in batch.column(2):
                n_words, found = bucket_list(t.as_py(), patterns, plan.buckets)
                own, n = np.unique(found, return_counts=True)
                out.append((n_words, len(found), own.astype("<u4").tobytes(), n.astype("<u4").tobytes()))
            sizes = [pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)]
            packed = [pa.array([o[i] for o in out], pa.binary()) for i in (2, 3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *sizes, *packed], names=schema.names)

    return materialise(rows.mapInArrow(run, schema), "features")


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a packed column, and how many each row has."""
    values = [v.as_py() for v in column]
    return np.frombuffer(b"".join(values), "<u4").astype(np.int64), np.array([len(v) // 4 for v in values], np.int64)


def bucket_totals(found: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket over all rows: each task adds its own, one row per bucket comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            own, _ = _unpacked(batch.column(0))
            n, _ = _unpacked(batch.column(1))
            total += np.bincount(own, n, buckets).astype(np.int64)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(total[hit], pa.int64())], names=["bucket", "n"])

    rows = found.select("buckets", "counts").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, np.int64)
    for r in rows.collect():
        total[r["bucket"]] = r["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the smoothed log ratio of each bucket."""
    b = len(corpus)
    s_all, t_all = float(corpus.sum()) + b, float(target.sum()) + b
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all))) for s, t in zip(corpus, target, strict=True)
    ], np.int64)


def weigh(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``(doc_id, row, n_words, n_features, weight)``: the floored mean gain of each row's features."""
    sent = found.sparkSession.sparkContext.broadcast(gain)
    rows = found.select("doc_id", "row", "n_words", "n_features", "buckets", "counts")
    schema = rows.select("doc_id", "row", "n_words", "n_features", F.lit(0).cast("long").alias("weight")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            own, sizes = _unpacked(batch.column(4))
            n, _ = _unpacked(batch.column(5))
            running = np.concatenate([[0], np.cumsum(gain[own] * n)])
            ends = np.cumsum(sizes)
            weight = (running[ends] - running[ends - sizes]) // np.maximum(batch.column(3).to_numpy(), 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(weight, pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def noise(key: Column, seed: int) -> Column:
    """Seeded Gumbel noise of a key in floored thousandths; a null key counts as an empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, plan: Plan = Plan(), text: str = "text", key: str = "doc_id", target_key: str = "item_id") -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null where not drawn) of every row of ``docs``.

    Counts cover all rows of both tables.  Of the rows with enough words the given percentage (rounded down)
    is drawn by score, ties to the smaller key, a null key last, rows that repeat a key in any order among
    themselves.  Null and empty texts have no features and weight 0.  An empty table gives no rows; an empty
    target leaves the smoothed counts of the corpus alone.  Other columns are not read.
    """
    found = features(docs, plan, text, key)
    wanted = features(target, plan, text, target_key)
    gain = gains(bucket_totals(found, plan.buckets), bucket_totals(wanted, plan.buckets))
    score = (F.col("weight") + noise(F.col("doc_id"), plan.seed)).alias("score")
    rows = materialise(weigh(found, gain).select("*", score), "scores")
    # Scores are integers between the bounds of gains and noise: their histogram does not grow with the rows.
    able = F.col("n_words") >= plan.least_words
    histogram = sorted(rows.where(able).groupBy("score").count().collect(), reverse=True)
    draw = sum(r["count"] for r in histogram) * plan.percent // 100
    cut, left = None, draw
    for r in histogram:
        if left <= 0:
            break
        cut, left = r["score"], left - r["count"]
    drawn = able & (F.col("score") >= F.lit(cut)) if draw else F.lit(False)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    best = ranked(rows.where(drawn), order, "drawn") if draw else rows.where(drawn).withColumn("rank", F.lit(0))
    columns = [F.col(c).cast("long").alias(c) if c != "doc_id" else F.col(c) for c in ("doc_id", "n_features", "weight", "score")]
    place = F.when(F.col("rank") <= draw, F.col("rank")).cast("long").alias("rank")
    return best.select(*columns, place).union(rows.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))
