"""Collapsed chats against a plain comparison of all conversations."""

import random

from pyspark.sql import functions as F

from marquee.llm import chat_collapse as cc


def brute(rows):
    convs = {}
    for conv, turn, role, text in set(rows):
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    seqs = {}
    for conv, turns in convs.items():
        seqs.setdefault(tuple(t[2:] for t in sorted(turns)), []).append(conv)
    out = {}
    for seq, ids in seqs.items():
        if not any(len(o) > len(seq) and o[: len(seq)] == seq for o in seqs):
            lines = ["<|im_start|>" + (r if has else "user") + "\n" + t + "<|im_end|>\n" for has, r, _, t in seq]
            for part in range((len(lines) - 1) // cc.BLOCK_TURNS + 1):
                out[min(ids), part] = (len(seq), len(ids), "".join(lines[part * cc.BLOCK_TURNS : (part + 1) * cc.BLOCK_TURNS]))
    return out


def run(spark, rows):
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("position", F.lit("x"))
    return {(r["conv_id"], r["part"]): (r["n_turns"], r["n_copies"], r["chat"]) for r in cc.format_chats(chats).collect()}


def test_collapse(spark):
    rng = random.Random(1)
    rows = []
    base = [[("user", f"hello {k}"), ("assistant", "hi"), ("user", None), (None, ""), ("user", "bye")] for k in range(4)]
    for conv in range(120):
        script = rng.choice(base)
        rows += [(conv, 10 * i, *turn) for i, turn in enumerate(script[: rng.randint(1, 5)])]
    rows += rows[:7]
    rows += [(None, 0, "user", "nobody's"), (500, None, "user", "no turn"), (500, 0, "user", "then"), (501, 3, "a", "tie"), (501, 3, "b", "tie")]
    rows += [(600, i, "user", f"turn {i}") for i in range(2500)] + [(601, i, "user", f"turn {i}") for i in range(1500)]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == {}
