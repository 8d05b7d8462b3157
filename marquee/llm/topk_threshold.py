"""Exact top-k inner products by a three-phase uniform threshold.

A vector's components are cut into a few lists of consecutive places; its score with a query is the sum of
its scores in the lists.  First every shard gathers the leaders of its lists and their whole scores, which
give each query a score that its answers reach for certain.  That cutoff goes to all shards and bounds
every list alike: what stays under its share of the cutoff in all lists cannot reach it as a whole.  The
entries above are collected, their other lists resolved, and only the best of a shard leave it.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialise

# Lists of a vector, and leaders of each that are resolved for the cutoff.
LISTS = 2
LEADERS = 64
# Vectors of a shard, queries of a block, and queries that a task compares at once.
SHARD_ROWS = 16_384
BLOCK_ROWS = 16_384
STEP_ROWS = 128
# Steps of a component; components that are larger than this leave a vector out, as non-finite ones do.
SCALE = 256
LARGEST = 1 << 24


def whole_vectors(vectors: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Stored ``(vec_id, v)``: one integer vector for each key, of rows that can be compared.

    Null keys, null vectors and vectors with a null, non-finite or oversized component take no part.  A
    row that is repeated counts once; of several vectors under one key the smallest counts.
    """
    raw = vectors.select(F.col(key).cast("long").alias("vec_id"), F.transform(column, lambda x: x.cast("double")).alias("e"))
    fit = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(LARGEST // SCALE)))
    steps = F.transform("e", lambda x: F.floor(x * SCALE).cast("int"))
    rows = raw.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & fit).select("vec_id", steps.alias("v"))
    return materialise(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1) if len(flat) else np.zeros((0, 0), np.int32)


def _lists(q: np.ndarray, v: np.ndarray, lists: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Both sides' components by list, as doubles where their products stay exact, else as integers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    kind = np.float64 if most < 2**53 else np.int64
    places = np.array_split(np.arange(q.shape[1]), lists)
    return [(q[:, p].astype(kind), np.ascontiguousarray(v[:, p].T.astype(kind))) for p in places]


def leader_scores(vectors: pa.Table, queries: pa.Table, keep: int, lists: int = LISTS, leaders: int = LEADERS) -> pa.Table:
    """Phase one in one shard: ``(qid, score)``, the best ``keep`` whole scores among the leaders of any list."""
    v, q, qid = _matrix(vectors["v"]), _matrix(queries["v"]), queries["qid"].to_numpy()
    out_q, out_s = [], []
    if len(v) and len(q):
        pairs = _lists(q, v, lists)
        n = min(leaders, len(v))
        for at in range(0, len(q), STEP_ROWS):
            scores = [a[at : at + STEP_ROWS] @ b for a, b in pairs]
            lead = np.concatenate([np.argpartition(s, len(v) - n, axis=1)[:, len(v) - n :] for s in scores], axis=1)
            lead.sort(axis=1)
            total = sum(np.take_along_axis(s, lead, 1) for s in scores)
            again = np.concatenate([np.zeros((len(lead), 1), bool), lead[:, 1:] == lead[:, :-1]], axis=1)
            for row, t, repeat in zip(range(at, at + len(lead)), total, again, strict=True):
                best = np.sort(t[~repeat])[::-1][:keep]
                out_q.append(np.full(len(best), qid[row]))
                out_s.append(best.astype(np.int64))
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.table({"qid": pa.array(join(out_q), pa.int64()), "score": pa.array(join(out_s), pa.int64())})


def collected_scores(vectors: pa.Table, queries: pa.Table, keep: int, lists: int = LISTS) -> pa.Table:
    """Phases two and three in one shard: ``(qid, vec_id, score)``, the shard's best ``keep`` at the cutoff or above.

    Each list reports the entries that exceed its least score by a uniform threshold: the cutoff, less the
    least scores of all lists, divided by their number.  Entries that no list reports are below the cutoff.
    """
    v, q = _matrix(vectors["v"]), _matrix(queries["v"])
    ids, qid = vectors["vec_id"].to_numpy(), queries["qid"].to_numpy()
    cut = queries["cut"].to_numpy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(v) and len(q):
        pairs = _lists(q, v, lists)
        for at in range(0, len(q), STEP_ROWS):
            scores = [a[at : at + STEP_ROWS] @ b for a, b in pairs]
            least = [s.min(axis=1).astype(np.int64) for s in scores]
            own = cut[at : at + STEP_ROWS]
            rest = own - reduce(np.add, least)
            # Integers: lists * (score - least) >= rest, that is score >= least + ceil(rest / lists).
            share = -(-rest // lists)
            reported = reduce(np.logical_or, [s >= (low + share)[:, None] for s, low in zip(scores, least, strict=True)])
            row, col = np.nonzero(reported)
            total = reduce(np.add, [s[row, col] for s in scores]).astype(np.int64)
            good = total >= own[row]
            row, col, total = row[good], col[good], total[good]
            order = np.lexsort((ids[col], -total, row))
            row, col, total = row[order], col[order], total[order]
            first = np.searchsorted(row, row)
            top = np.arange(len(row)) - first < keep
            found.append((qid[at + row[top]], ids[col[top]], total[top]))
    parts = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3)]
    return pa.table({n: pa.array(p, pa.int64()) for n, p in zip(("qid", "vec_id", "score"), parts, strict=True)})


def _best(rows: DataFrame, by: str, keep: int, order: list) -> DataFrame:
    """The first ``keep`` rows of each group; Spark cuts in each task before it shuffles."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= keep)


def search(vectors: DataFrame, every: int = 50, k: int = 5, column: str = "embedding", key: str = "vec_id",
           lists: int = LISTS, leaders: int = LEADERS, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the best ``k`` other vectors of each key divisible by ``every``.

    The score is the integer inner product of the vectors in steps of 1/256; ties go to the smaller key.
    Vectors of other lengths than the query's are no candidates, and empty ones all score 0.  Of equal
    vectors only the ``k + 1`` smallest keys can be an answer, so no more are compared; equal queries are
    asked once.  Queries go in blocks to every shard; a shard answers with ``k + 1`` rows at most.  An
    empty table, or one without queries, gives no rows.  Other columns are not read.
    """
    keep = k + 1
    own = whole_vectors(vectors, column, key)
    some = _best(own, "v", keep, [F.col("vec_id")]).select("vec_id", "v")
    rows, asked = materialise(some, "candidates"), own.where(F.col("vec_id") % every == 0)
    members = materialise(asked.select(F.col("vec_id").alias("query_id"), F.first("vec_id").over(Window.partitionBy("v").orderBy("vec_id")).alias("qid"), "v"), "members")
    queries = members.where("query_id = qid").select("qid", "v")
    shards, blocks = max(1, -(-rows.count() // shard_rows)), max(1, -(-queries.count() // block_rows))

    def met(queries: DataFrame, work, schema: str) -> DataFrame:
        """``work`` on every shard with every block of queries of its length."""
        each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        size = F.size("v").alias("size")
        left = rows.select("*", size, F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), each(blocks).alias("block"))
        right = queries.select("*", size, F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int").alias("block"), each(shards).alias("shard"))
        keys = ["size", "shard", "block"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, schema)

    leading = met(queries, lambda a, b: leader_scores(a, b, keep, lists, leaders), "qid long, score long")
    cuts = _best(leading, "qid", keep, [F.col("score").desc()]).groupBy("qid").agg(F.min("score").alias("cut"), F.count("*").alias("n"))
    # With fewer scores than wanted everything is an answer.
    least = F.when(F.col("n") == keep, F.col("cut")).otherwise(F.lit(-(1 << 62)))
    known = materialise(queries.join(cuts.select("qid", least.alias("cut")), "qid"), "cutoffs")
    answers = met(known, lambda a, b: collected_scores(a, b, keep, lists), "qid long, vec_id long, score long")
    order = [F.col("score").desc(), F.col("vec_id")]
    top = materialise(_best(answers, "qid", keep, order).drop("rank"), "answers")
    others = members.select("query_id", "qid").join(top, "qid").where("query_id <> vec_id")
    return _best(others, "query_id", k, order).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
