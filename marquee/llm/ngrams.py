"""Hashed n-gram counts of texts, their document frequencies, and a bounded set of labelled rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import mix64
from marquee.session import materialise

Counter = Callable[[str], "np.ndarray | None"]


def hashed(columns: list[np.ndarray], bits: int, seed: int) -> np.ndarray:
    """Place (below 2**bits) of each n-gram given by its columns."""
    total = np.full(len(columns[0]), seed, np.uint64)
    for column in columns:
        total = total * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64)
    return (mix64(total) >> np.uint64(64 - bits)).astype(np.int64)


def sample_keys(rows: DataFrame, key: str, label: str, per_label: int) -> dict[int, object]:
    """Key -> label of at most ``per_label`` rows of each label, those with the smallest hash of the key.

    Rows without key or label are left out; a key with several labels counts with the smallest.  Counts
    per label first narrow the hash to about twice the rows wanted, so that no task ranks more of a label,
    however many tasks there are.
    """
    one = rows.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.min(label).alias("label"))
    hashed_one = one.withColumn("h", F.xxhash64("k"))
    share = F.lit(0.0)
    for r in one.groupBy("label").count().collect():
        share = F.when(F.col("label") == r["label"], min(1.0, 2.0 * per_label / r["count"])).otherwise(share)
    near = hashed_one.where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30))
    ranked = near.selectExpr("k", "label", "row_number() OVER (PARTITION BY label ORDER BY h, k) AS r")
    return {r["k"]: r["label"] for r in ranked.where(F.col("r") <= per_label).collect()}


def gather(docs: DataFrame, key: str, text: str, dims: int, counter: Callable[[], Counter], wanted: set) -> tuple[np.ndarray, int, dict]:
    """One pass over all rows: ``(document frequency of each place, documents, counts of the wanted keys)``.

    ``counter()`` makes, in the task, the function from a text to its counts (None: not counted).  Each
    task adds up its own frequencies; places are then summed by Spark, ``dims`` numbers reach the driver.
    Wanted keys (a bounded set) come back as sparse counts; of a repeated key the first by value counts.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, keys, seen = counter(), sent.value, set()
        df, n = np.zeros(dims, np.int64), 0
        for batch in batches:
            picked: dict[str, list] = {"k": [], "at": [], "n": []}
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = count(value.as_py() or "")
                if counts is None:
                    continue
                n += 1
                here = counts > 0
                df += here
                if k in keys and k not in seen:
                    seen.add(k)
                    at = np.flatnonzero(here)
                    picked["k"].append(k)
                    picked["at"].append(at.astype(np.int32))
                    picked["n"].append(counts[at].astype(np.int32))
            if picked["k"]:
                yield _rows(picked["k"], picked["at"], picked["n"])
        yield _rows([None, None], [np.flatnonzero(df).astype(np.int32), np.zeros(1, np.int32) - 1], [df[df > 0], np.array([n])])

    found = materialise(docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, "k long, at array<int>, n array<long>"), "ngrams")
    sums = found.where("k IS NULL").select(F.explode(F.arrays_zip("at", "n")).alias("x")).groupBy("x.at").agg(F.sum("x.n").alias("n"))
    total = {r["at"]: r["n"] for r in sums.collect()}
    frequencies = np.zeros(dims, np.int64)
    for place, n in total.items():
        if place >= 0:
            frequencies[place] = n
    first = found.where("k IS NOT NULL").groupBy("k").agg(F.min(F.struct("at", "n")).alias("v"))
    rows = first.select("k", "v.at", "v.n").toArrow()
    counts = {
        k.as_py(): (at.values.to_numpy().astype(np.int64), n.values.to_numpy().astype(np.float64))
        for k, at, n in zip(rows["k"], rows["at"], rows["n"], strict=True)
    }
    return frequencies, int(total.get(-1, 0)), counts


def _rows(keys: list, places: list, counts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(places, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))], names=["k", "at", "n"]
    )


def idf(frequencies: np.ndarray, documents: int) -> np.ndarray:
    return np.log((1.0 + documents) / (1.0 + frequencies)) + 1.0


def weighted(places: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """TF-IDF values at ``places`` with length 1; term frequency enters by its logarithm."""
    values = (1.0 + np.log(counts)) * weights[places]
    norm = np.sqrt((values * values).sum())
    return values / norm if norm else values
