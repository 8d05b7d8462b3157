"""Quality votes and language identification: held-out accuracy, brute-force votes, odd inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import langid_ftrl, quality_knn
from marquee.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    rows = QUERIES["op8_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd_inputs(spark):
    rows = [(i, t, lang, "x") for i, (t, lang) in enumerate(
        [("die der und das ist", "de"), ("the of and is", "en")] * 20 + [(None, "en"), ("", "en"), ("12 #", "de"), ("und der", None), ("THE OF " * 30_000, "en")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score_2 string")
    model = langid_ftrl.fit(docs)
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid_ftrl.predict(docs, model).collect()}
    assert len(out) == len(rows) and [out[i] for i in (40, 41, 42)] == [("und", 0.0)] * 3
    assert out[43][0] == "de" and out[44][0] == "en" and out[0][0] == "de"
    assert langid_ftrl.predict(docs, langid_ftrl.fit(docs.limit(0))).where("lang_pred <> 'und'").count() == 0
    assert {r["lang_pred"] for r in langid_ftrl.predict(docs, langid_ftrl.fit(docs.where("lang = 'en'"))).collect()} == {"en", "und"}
    with pytest.raises(ValueError):
        langid_ftrl.predict(docs.withColumn("score", F.lit(1)), model)


def test_temperature_softens_wrong_certainty():
    scores, langs = np.array([[4.0, 0.0], [4.0, 0.0], [0.0, 4.0]]), np.array([0, 1, 1])
    assert langid_ftrl.best_temperature(scores, langs) > 1.0


def test_quality_held_out(spark):
    scored = QUERIES["op1_quality"](spark, SF)
    rows = scored.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9
    assert scored.count() == 1000 and scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_votes_match_all_cosines():
    rng = np.random.default_rng(2)
    voters = quality_knn.Voters(np.ones(1), np.ones((1, 1)), quality_knn.unit(rng.standard_normal((300, 8))), rng.integers(0, 2, 300).astype(float))
    rows = quality_knn.unit(rng.standard_normal((70, 8)))
    for row, got in zip(rows, quality_knn.vote(rows, voters), strict=True):
        cosine = [float(row @ v) for v in voters.vectors]
        near = sorted(range(300), key=lambda i: -cosine[i])[: quality_knn.NEIGHBOURS]
        weight = [max(cosine[i], 0) ** quality_knn.SHARPNESS for i in near]
        assert got == pytest.approx(sum(w * voters.labels[i] for w, i in zip(weight, near, strict=True)) / sum(weight))


def test_repeats_are_told_at_any_length():
    """The step says which share of a text's windows is new, for short texts and for very long ones."""
    count, rng = quality_knn.make_counter(), np.random.default_rng(3)
    first = 2 << quality_knn.BITS

    def step(text):
        steps = count(text)[first:].reshape(quality_knn.REPEAT_STEPS, -1).sum(1)
        return int(np.flatnonzero(steps)[0])

    for length in (300, 6_000, 1_000_000):
        plain = "".join(map(chr, rng.integers(97, 123, length)))
        assert step(plain) == quality_knn.REPEAT_STEPS - 1
        windows = {(plain[: length // 3] * 3)[i : i + 12] for i in range(length // 3 * 3 - 11)}
        assert step(plain[: length // 3] * 3) == quality_knn.REPEAT_STEPS * len(windows) // (length // 3 * 3 - 11)


def plain_ftrl(rows, n_langs, alpha=0.5, beta=1.0, l1=0.02, l2=0.05, epochs=4):
    """Follow the regularised leader, one weight at a time."""
    z, n = {}, {}

    def weight(i, k):
        zi = z.get((i, k), 0.0)
        if abs(zi) <= l1:
            return 0.0
        return -(zi - (l1 if zi > 0 else -l1)) / ((beta + n.get((i, k), 0.0) ** 0.5) / alpha + l2)

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            at, x, lang = rows[r]
            w = {(i, k): weight(i, k) for i in at for k in range(n_langs)}
            scores = [sum(w[i, k] * v for i, v in zip(at, x, strict=True)) for k in range(n_langs)]
            top = max(scores)
            e = [np.exp(s - top) for s in scores]
            for k in range(n_langs):
                error = e[k] / sum(e) - (k == lang)
                for i, v in zip(at, x, strict=True):
                    g = error * v
                    old = n.get((i, k), 0.0)
                    z[i, k] = z.get((i, k), 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / alpha * w[i, k]
                    n[i, k] = old + g * g
    return {key: weight(*key) for key in z}


def test_ftrl_matches_plain_loops():
    rng = np.random.default_rng(4)
    rows = [(np.sort(rng.choice(40, 6, replace=False)), rng.random(6), int(rng.integers(0, 3))) for _ in range(30)]
    got, want = langid_ftrl.ftrl(rows, 3), plain_ftrl(rows, 3)
    assert all(got[i, k] == pytest.approx(w, abs=1e-9) for (i, k), w in want.items())
    assert np.count_nonzero(got) == sum(w != 0 for w in want.values())


def test_predictions_match_plain_python(spark):
    texts = ["die der und das ist", "the of and is", "UND the 12 Straße", "a", "ñandú año", None, "  "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    learned = spark.createDataFrame([(i, t, "de" if i % 2 else "en") for i, t in enumerate(["the of and is a", "die der und das"] * 15)], "doc_id long, text string, lang string")
    model = langid_ftrl.fit(learned)
    count = langid_ftrl.make_counter()
    for r in langid_ftrl.predict(docs, model).collect():
        counts = count(r["text"]) if r["text"] else None
        if counts is None:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        at = [i for i, c in enumerate(counts) if c]
        x = [(1 + np.log(counts[i])) * model.idf[i] for i in at]
        norm = sum(v * v for v in x) ** 0.5
        scores = [sum(v / norm * model.weights[i, k] for i, v in zip(at, x, strict=True)) / model.temperature for k in range(2)] if norm else [0.0, 0.0]
        e = [np.exp(s - max(scores)) for s in scores]
        best = max(range(2), key=lambda k: (e[k], -k))
        assert r["lang_pred"] == model.langs[best] and r["score"] == pytest.approx(e[best] / sum(e), rel=1e-6)


def test_quality_odd_inputs(spark):
    docs = spark.createDataFrame([(1, "good words here", 1), (2, None, 1), (3, "", 1), (4, "x", 1), (1, "again", 1), (None, "no key", 1), (5, "### " * 40_000, 1)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (2, None)], "doc_id long, quality int")
    for voters in (quality_knn.fit(docs, labels), quality_knn.fit(docs, labels.limit(0)), quality_knn.fit(docs.limit(0), labels)):
        rows = quality_knn.score(docs, voters).collect()
        assert len(rows) == 7 and all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["score"] == 0 for r in rows if not r["text"])
