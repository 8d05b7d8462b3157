"""The mix against targets reshared step by step, and its budgets word by word."""

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from marquee.llm import budget_mix as bm


def reshared(sizes, weights=(3, 1, 2), percent=150, cap=2):
    """Excess over the cap goes to the open sources by weight until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, shut = sum(sizes.values()) * percent / 100, {}
    while True:
        rest, open_w = budget - sum(shut.values()), sum(w[s] for s in names if s not in shut)
        share = {s: rest * w[s] / open_w for s in names if s not in shut}
        above = [s for s in share if share[s] > cap * sizes[s] + 1e-9]
        if not above:
            return shut | share
        shut |= {s: cap * sizes[s] for s in above}


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    out = bm.mix(docs).select("_carry.doc_id", "size", "source_size", "target", "times")
    return docs, [tuple(r) for r in out.collect()]


def check(rows, out):
    size = {}
    by = defaultdict(int)
    for i, t, s in rows:
        size[i] = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        by[s] += size[i]
    want, source = reshared(dict(by)), {i: s for i, _, s in rows}
    taken = defaultdict(int)
    assert len(out) == len(rows)
    for i, n, total, target, times in out:
        assert n == size[i] and total == by[source[i]] and abs(target - want[source[i]]) < 1e-6 * max(1, target)
        assert 0 <= times <= 2
        taken[source[i]] += n * times
    return {s: (taken[s], want[s]) for s in want}


def test_budgets_are_met(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 90)), rng.choice(["a", "b", "é", None, "b"])) for i in range(1500)]
    rows += [(5000 + i, "same text of words here", "a") for i in range(900)]
    rows += [(9001, None, "a"), (9002, "", "none"), (9003, "x " * 30_000, "tiny")]
    _, out = run(spark, rows)
    for source, (taken, want) in check(rows, out).items():
        assert abs(taken - want) <= (1 if source != "tiny" else 30_000), (source, taken, want)
    assert sorted(out) == sorted(run(spark, list(reversed(rows)))[1])


def test_edge_tables(spark):
    assert run(spark, [])[1] == []
    assert [r[3:] for r in run(spark, [(1, None, None), (1, None, None)])[1]] == [(0.0, 0), (0.0, 0)]
    docs, _ = run(spark, [(1, "a b c d", "s")] * 4)
    mixed = bm.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == 6


def test_choose_lengths_against_all_subsets():
    rng = random.Random(9)
    for _ in range(200):
        lengths = sorted(rng.sample(range(1, 30), rng.randint(1, 5)))
        counts = [rng.randint(1, 3) for _ in lengths]
        sums = {0}
        for n, c in zip(lengths, counts, strict=True):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        budget = rng.randint(0, max(sums))
        got = bm.choose_lengths(lengths, counts, budget)
        assert all(0 <= g <= c for g, c in zip(got, counts, strict=True))
        words = sum(g * n for g, n in zip(got, lengths, strict=True))
        assert words <= budget and budget - words <= max(lengths)
        if max(sums) <= 2 * max(lengths):
            assert words == max(s for s in sums if s <= budget)
