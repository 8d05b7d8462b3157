"""Exact top-k search against comparing everything."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from marquee.llm import topk_threshold as tk


def expected(rows, every=50, k=5):
    by_key = {}
    for key, v in rows:
        if key is None or v is None or any(x is None or not math.isfinite(x) or abs(x) >= tk.LARGEST // tk.SCALE for x in v):
            continue
        steps = [math.floor(256 * float(np.float32(x))) for x in v]
        by_key[key] = min(steps, by_key.get(key, steps))
    out = []
    for q in by_key:
        if q % every == 0:
            near = sorted((-sum(a * b for a, b in zip(by_key[q], v, strict=True)), i) for i, v in by_key.items() if i != q and len(v) == len(by_key[q]))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(near[:k], 1)]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(k, v, "clash", 1) for k, v in rows], "vec_id long, embedding array<float>, score string, rank int")
    return sorted(tuple(r) for r in tk.search(frame, **options).collect())


def sample(n=1200, dim=24, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).astype(np.float32).tolist()) for i in range(n)]
    hot = rng.normal(size=dim).astype(np.float32).tolist()
    rows += [(n + i, hot) for i in range(700)]
    rows += [(5000 + i, [0.0] * dim) for i in range(60)]
    rows += [(6000 + i, rng.integers(-1, 2, dim).astype(float).tolist()) for i in range(300)]
    rows += [(7000, None), (7050, [None] * dim), (7100, [math.nan] + [1.0] * (dim - 1)), (7150, [math.inf] * dim), (None, hot), (7200, [1e9] * dim)]
    rows += [(8000 + i, [float(i), 1.0, -2.0]) for i in range(101)] + [(9000, []), (9050, []), (9051, [])]
    rows += [rows[0], rows[0], (100, [-3.0] * dim)]
    return rows


@pytest.mark.parametrize("options", [{}, {"shard_rows": 300, "block_rows": 7}, {"lists": 4, "leaders": 3, "shard_rows": 500}])
def test_against_all_pairs(spark, options):
    rows = sample()
    assert run(spark, rows, **options) == expected(rows)


def test_fewer_rows_than_wanted_and_empty(spark):
    assert run(spark, []) == []
    few = [(0, [1.0, 2.0]), (50, [0.5, 0.5]), (7, [-1.0, 0.25])]
    assert run(spark, few) == expected(few)
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, few, every=7, k=1) == expected(few, 7, 1)


def test_large_components_stay_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-65_000, 65_000) for _ in range(40)]) for i in range(120)]
    assert run(spark, rows) == expected(rows)


def test_lists_report_few_entries():
    """The cutoff of phase one leaves most entries unreported, and loses none at or above it."""
    rng = np.random.default_rng(5)
    v = np.floor(256 * rng.normal(size=(4000, 32))).astype(np.int32)
    table = lambda x, **more: pa.table({**more, "v": pa.array(list(x), pa.list_(pa.int32()))})
    vectors, queries = table(v, vec_id=np.arange(4000)), table(v[:20], qid=np.arange(20))
    lead = tk.leader_scores(vectors, queries, 6).to_pandas()
    cut = lead.groupby("qid")["score"].min()
    true = np.sort(v[:20].astype(np.int64) @ v.T.astype(np.int64), axis=1)[:, -6]
    assert (cut.to_numpy() <= true).all()
    got = tk.collected_scores(vectors, queries.append_column("cut", pa.array(cut.to_numpy())), 6).to_pandas()
    assert (got.groupby("qid")["score"].min().to_numpy() == true).all() and (got.groupby("qid").size() == 6).all()
