"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
from zlib import crc32

from marquee.llm import target_resample as tr

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, longest):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def expected(docs, target, plan):
    bucket = lambda g: crc32(g.encode()) % plan.buckets
    corpus, wanted = [0] * plan.buckets, [0] * plan.buckets
    for texts, into in (([t for _, t in docs], corpus), (target, wanted)):
        for t in texts:
            for g in grams(t, plan.words)[1]:
                into[bucket(g)] += 1
    s_all, t_all = sum(corpus) + plan.buckets, sum(wanted) + plan.buckets
    gain = [math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(corpus, wanted, strict=True)]
    rows = []
    for key, text in docs:
        n, found = grams(text, plan.words)
        weight = sum(gain[bucket(g)] for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{plan.seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, n >= plan.least_words])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[: plan.percent * len(able) // 100]
    place = {id(r): i for i, r in enumerate(drawn, 1)}
    return [(*r[:4], place.get(id(r))) for r in rows]


def run(spark, docs, target, plan):
    frame = spark.createDataFrame([(k, t, "clash", 3) for k, t in docs], "doc_id long, text string, score string, row int")
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    return [tuple(r) for r in tr.resample(frame, wanted, plan).collect()]


def as_set(rows):
    return sorted(rows, key=repr)


def sample(n=500):
    rng = random.Random(8)
    vocabulary = ["alpha", "Beta", "x1", "naïve", "日本語", "don't", "a-b", "İstanbul", "K"]
    text = lambda: "".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\n", ", ", "\x00", " "]) for _ in range(rng.randint(0, 60)))
    docs = [(i, text()) for i in rng.sample(range(-50, 5000), n)]
    docs += [(9001, None), (9002, ""), (9003, "  .. ,, "), (9004, "word " * 50_000), (None, "beta " * 30)]
    return docs, [text() for _ in range(40)] + [None, ""]


def test_single_words(spark):
    docs, target = sample()
    assert as_set(run(spark, docs, target, tr.Plan())) == as_set(expected(docs, target, tr.Plan()))


def test_longer_runs_few_buckets_and_ties(spark):
    docs, target = sample()
    plan = tr.Plan(words=3, buckets=61, least_words=1, percent=45)
    assert as_set(run(spark, docs, target, plan)) == as_set(expected(docs, target, plan))


def test_equal_rows_and_edge_tables(spark):
    same = [(7, "beta " * 25)] * 200
    ranks = sorted(r[4] for r in run(spark, same, [], tr.Plan()) if r[4])
    assert ranks == list(range(1, 21))
    assert run(spark, [], ["a b"], tr.Plan()) == []
    few = [(1, "a " * 20), (2, None)]
    assert as_set(run(spark, few, [], tr.Plan())) == as_set(expected(few, [], tr.Plan()))


def test_overlapping_runs_keep_to_word_bounds():
    found = tr.run_pattern(2).finditer(b" ab c ab c", overlapped=True)
    assert [m.group() for m in found] == [b"ab c", b"c ab", b"ab c"]
    assert not list(tr.run_pattern(3).finditer(b"one two ", overlapped=True))
