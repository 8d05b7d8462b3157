"""The rule ledger, its policies and ablations against plain Python."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from marquee.llm import rule_ledger as rl
from marquee.session import materialise

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    t = text or ""
    words = WORD.findall(t)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    covered = {p for i, w in enumerate(windows) if n[w] > 1 for p in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_capitals": len(re.findall("[A-Z]", t)),
    }


def failed(m):
    return {
        "few_words": m["n_words"] < 10, "repeated_words": 100 * m["n_repeat_words"] > 20 * m["n_words"],
        "symbols": 100 * m["n_symbols"] > 10 * m["word_chars"], "repeated_lines": 100 * m["n_dup_lines"] > 30 * m["n_lines"],
        "short_words": m["word_chars"] < 2 * m["n_words"], "long_words": m["word_chars"] > 20 * m["n_words"], "capitals": 2 * m["n_capitals"] > m["word_chars"],
    }


def sample():
    rng = random.Random(5)
    texts = [None, "", " \n\t", "one two", "A B C D E F G H I J K", "## ** $$ word " * 5, "same line here\n" * 9, "x " * 40, "long" * 30 + " " + "word" * 30]
    for _ in range(80):
        words = [rng.choice(["alpha", "beta", "GAMMA", "d", "été", "#"]) for _ in range(rng.randint(5, 40))]
        texts.append(" ".join(words + words[: rng.choice([0, 0, 8])]) + rng.choice(["", "\nend\nend"]))
    texts += ["a b c d e " * 20_000, "a b c d e " * 20_000]
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    return rows + [rows[4], (None, "null key with some words in it to be kept by all rules", "clash")]


def test_measurements_bits_and_policies(spark):
    rows = sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = sorted((tuple(r) for r in rl.ledger(docs).select("doc_id", *measured(""), "fail_bits").collect()), key=repr)
    want = []
    for key, text, _ in rows:
        m = measured(text)
        want.append((key, *m.values(), sum(1 << i for i, bad in enumerate(failed(m).values()) if bad)))
    assert got == sorted(want, key=repr) and list(failed(measured(""))) == list(rl.RULES)
    book = materialise(rl.ledger(docs), "book")
    for policy in ("v1", "v2", ("symbols", "capitals")):
        names = rl.POLICIES.get(policy, policy) if isinstance(policy, str) else policy
        kept = {r["doc_id"] for r in rl.apply_policy(book, policy).where("kept").collect()}
        assert kept == {k for k, t, _ in rows if not any(failed(measured(t))[n] for n in names)}


def test_ablations_from_a_stored_ledger(spark):
    rows = sample()
    book = materialise(rl.ledger(spark.createDataFrame(rows, "doc_id long, text string, n_words string")), "book")
    for policy in ("v1", "v2"):
        fails = [{n for n in rl.POLICIES[policy] if failed(measured(t))[n]} for _, t, _ in rows]
        want = {n: (sum(n in f for f in fails), sum(f == {n} for f in fails)) for n in rl.POLICIES[policy]}
        assert {r["rule"]: (r["n_failed"], r["n_only"]) for r in rl.ablations(book, policy).collect()} == want
    assert {(r["n_failed"], r["n_only"]) for r in rl.ablations(book.where(F.lit(False))).collect()} == {(0, 0)}
    assert rl.ledger(spark.createDataFrame([], "doc_id long, text string")).count() == 0
