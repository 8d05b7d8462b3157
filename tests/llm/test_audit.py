"""The filter audit against removing documents filter by filter, in plain Python."""

import itertools
import random
import re
from collections import Counter

from marquee.llm import filter_audit as fa

SCHEMA = "doc_id long, text string, source string, mask string"


def failing(rows):
    """Letters that each row fails, by the definitions."""
    smallest = {}
    for i, t, _, _ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    out = []
    for i, t, _, _ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = ""
        if len(words) < 200:
            fails += "A"
        if 100 * len(set(words)) < 50 * len(words):
            fails += "B"
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            fails += "C"
        if re.search(r"[#$%&*|]", t):
            fails += "D"
        if i is not None and i > smallest[t]:
            fails += "E"
        out.append(fails)
    return out


def expected(rows, labels):
    # A null key meets no label.
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails, want = failing(rows), {}
    for part in {s or "" for _, _, s, _ in rows}:
        own = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        share = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[1]]
                stay = [d for d in left if name not in d[1]]
                want[part, order, step] = [
                    len(stay), len(gone), sum(name in f for _, f in own) - len(gone), sum(f == name for _, f in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
                share[name] += len(gone)
                left = stay
        for key in [k for k in want if k[0] == part]:
            want[key].append(share[key[1][key[2] - 1]])
    return want


def made(spark, rows, labels):
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = fa.filter_audit(docs, marks).collect()
    found = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in out}
    assert len(found) == len(out)
    return found


def sample(seed=4, n=400):
    rng = random.Random(seed)
    texts = [None, "", "a b # c", "SHOUT " * 3, "same text here", "w " * 300, " ".join(f"é{i}" for i in range(250)), "x y\x0bz\x1cq"]
    texts += [" ".join(rng.choices([f"v{j}" for j in range(400)], k=rng.choice([20, 210, 260]))) + rng.choice(["", " A&B", " TITLE IN CAPS"]) for _ in range(60)]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, "", "é"]), "clash") for i in rng.sample(range(5000), n)]
    rows += [rows[0]] * 3 + [(None, "same text here", "a", None), (None, None, None, None), (9999, "long " * 40_000, "a", None)]
    rows += [(10_000 + i, "one hot text", "hot", None) for i in range(300)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in rng.sample(range(5000), 3000)] + [(rows[0][0], 1, 1)] * 2 + [(None, 1, 1)]
    return rows, labels


def test_every_order_and_step(spark):
    rows, labels = sample()
    assert made(spark, rows, labels) == expected(rows, labels)


def test_edge_tables(spark):
    assert made(spark, [], []) == {}
    rows = [(1, None, None, None)]
    assert made(spark, rows, []) == expected(rows, [])


def test_sketch_clears_only_unique_texts(spark):
    """No repeated text is cleared; most unique ones are, also where pages are many or full."""
    rows = [(i, f"text {i if i % 3 else i % 50}", "s", None) for i in range(30_000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    flags = fa.measure(docs)
    repeats = {t for t, n in Counter(r[1] for r in rows).items() if n > 1}
    for pages in (1, 7, fa.sketch_pages(len(rows))):
        cells = fa.sketch(flags, pages)
        told = docs.select("text", *fa._hashed("text"))
        possible = {r["text"] for r in fa._with_bits(told, cells, pages).where("possible").select("text").collect()}
        assert repeats <= possible
        if pages > 1:
            assert len(possible - repeats) < 0.02 * len(rows)
