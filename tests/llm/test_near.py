"""Near duplicates of texts and vectors against all pairs."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import common, hnsw_dedup, minhash_bbit


def reach(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in ids}


def shingles(text, words):
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


@pytest.mark.parametrize("near", [minhash_bbit.Near(3, 85), minhash_bbit.Near(5, 80)])
def test_texts(spark, near):
    rng = random.Random(4)
    vocabulary = [f"w{i}é" for i in range(400)]
    texts = [None, "", " \t\n", "one", "One", "one two", "ONE two", "Ä b c", "ä b c", "x" * 100_000]
    base = [rng.choice(vocabulary) for _ in range(150)]
    # A group that straddles the threshold: copies near a hub, but not all near one another.
    for _ in range(150):
        copy = list(base)
        for at in rng.sample(range(150), rng.randint(0, 5)):
            copy[at] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(60)] + texts[20:40]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, component_id string").repartition(5)
    got = {r["doc_id"]: r for r in minhash_bbit.find(docs, near).collect()}
    sets = {i: shingles(t, near.words) for i, t in enumerate(texts)}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= near.percent * len(sets[a] | sets[b])]
    want = reach(sets, links)
    assert len(got) == len(texts)
    for i in sets:
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(sets[i]), want[i], want[i] == i)
    alone = minhash_bbit.deduplicated(docs, near)
    assert alone.columns == docs.columns and alone.count() == len(set(want.values()))


def test_texts_with_odd_keys(spark):
    docs = spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, "q r s t"), (3, None), (3, None)], "doc_id long, text string")
    rows = sorted((tuple(r) for r in minhash_bbit.find(docs).drop("_carry").collect()), key=repr)
    assert len(rows) == 6 and sum(r[-1] for r in rows) == 4
    assert {r[2] for r in rows if r[0] == 7} == {7}
    assert minhash_bbit.find(docs.limit(0)).count() == 0


def test_chances_at_the_threshold():
    """Neither bands nor packed minima lose more than one pair in a million at the threshold."""
    for near in (minhash_bbit.Near(3, 85), minhash_bbit.Near(5, 80)):
        j = near.percent / 100
        assert (1 - j**minhash_bbit.BAND_ROWS) ** near.bands <= 1e-6
        draws = np.random.default_rng(1).binomial(minhash_bbit.MINIMA, 1 / 16 + 15 / 16 * j, 3_000_000)
        assert (draws < near.least_equal).mean() <= 2e-6 < (draws < near.least_equal + 4).mean()
    with pytest.raises(ValueError):
        minhash_bbit.Near(5, 60)


def test_long_words_do_not_collide():
    """Two words of one length whose polynomial hashes are equal for any odd base."""
    word = [0]
    while len(word) < 4096:
        word += [1 - b for b in word]
    texts = [" ".join("".join("ab"[b ^ flip] for b in word) for _ in range(5)).encode() for flip in (0, 1)]
    one, two = minhash_bbit.shingle_sets(texts, 5)
    assert len(one) == len(two) == 1 and one[0] != two[0]


def test_estimate_is_corrected(spark):
    near = minhash_bbit.Near(1, 80)
    rows = [(0, " ".join(f"a{i}" for i in range(1000))), (1, " ".join(f"a{i}" for i in range(250, 1250)))]
    signed = minhash_bbit.signatures(spark.createDataFrame(rows, "doc_id long, text string"), near, "text", "doc_id", ["doc_id"])
    a, b = (signed.where(F.col("key") == k).select(F.col("sig").alias(s)) for k, s in ((0, "a"), (1, "b")))
    got = a.crossJoin(b).select(minhash_bbit.estimated(minhash_bbit.equal_minima("a", "b")).alias("j")).first()["j"]
    assert abs(got - 0.6) < 0.12


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, i) for i in range(2000, 2200)] + [(None, 1)]
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {i for e in edges for i in e if i is not None and None not in e and e[0] != e[1]}
    assert got == reach(ids, [e for e in edges if None not in e])


@pytest.mark.parametrize("shard_rows", [16_384, 60])
def test_vectors(spark, shard_rows):
    rng = np.random.default_rng(6)
    rows, hub = [], rng.standard_normal(16)
    for i in range(320):
        v = hub + 0.11 * rng.standard_normal(16) if i % 2 else rng.standard_normal(16)
        rows.append((i, v.tolist(), i % 4 // 2))
    rows += [(400 + i, rows[i][1], rows[i][2]) for i in range(30)] + [(450, [2 * x for x in rows[1][1]], rows[1][2])]
    rows += [(500, None, 1), (501, [0.0] * 16, 1), (502, [None] + [1.0] * 15, 1), (503, [float("nan")] * 16, 1), (504, rows[0][1], None), (505, [1.0, 2.0], 1), (506, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("row", F.lit("x"))
    got = {r["vec_id"]: r for r in hnsw_dedup.find(df, shard_rows=shard_rows).collect()}
    x = {i: np.asarray(np.asarray(v, np.float32), np.float64) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    label = {r[0]: r[2] for r in rows}
    links = [
        (a, b) for a, b in itertools.combinations(x, 2)
        if label[a] == label[b] and len(x[a]) == len(x[b]) and x[a] @ x[b] / np.linalg.norm(x[a]) / np.linalg.norm(x[b]) >= 0.98
    ]
    want = reach([r[0] for r in rows], links)
    assert len(got) == len(rows)
    true = sum(sum(i in e for e in links) for i in x)
    assert 0.99 * true <= sum(r["n_links"] for r in got.values()) <= true
    assert all(got[i]["component_id"] == want[i] and got[i]["kept"] == (want[i] == i) for i in want)


def test_no_vectors(spark):
    assert hnsw_dedup.find(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


class Narrow(hnsw_dedup.Graph):
    """Finds hot groups at any beam, links of pairs from a beam of 128 on only."""

    def search(self, q, beam, least):
        close = q @ self.x[: self.n].T >= least
        hot = close.sum(1) > 100
        nearest = np.where(hot[:, None] | (beam >= 128), (-(q @ self.x[: self.n].T)).argsort(1)[:, :beam], 0)
        rows, nodes = np.nonzero(close & (hot[:, None] | (beam >= 128)))
        return rows, nodes, nearest


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def asked(x, queries, own):
    ids = np.arange(len(x)) * 3
    query_ids = ids if own else 1 + np.arange(len(queries)) * 3
    return hnsw_dedup.Asked(x, ids, np.ones(len(x), np.int64), queries, query_ids, 0.98)


def exact_links(x, queries, own):
    near = queries @ x.T >= 0.98
    return near.sum(1) - (1 if own else 0)


def test_audit_counts_hot_rows_once_and_sees_shards_without_links():
    rng = np.random.default_rng(3)
    hot = unit(np.ones((1, 32)) + rng.normal(0, 0.001, (400, 32)))
    pairs = np.repeat(unit(rng.normal(size=(312, 32))), 2, axis=0) + rng.normal(0, 0.001, (624, 32))
    x = unit(np.concatenate([hot, pairs]))[rng.permutation(1024)]
    graph = Narrow(x)
    got = asked(x, x, True)
    beam, recall, brute = hnsw_dedup.ask(graph, got)
    assert beam == 128 and recall >= 0.99 and (got.links == exact_links(x, x, True)).all()
    assert brute == 400 + np.count_nonzero(np.isin(np.random.default_rng(7).permutation(1024)[:48], np.flatnonzero(exact_links(x, x, True) < 100)))
    # Another shard without a link there: nearest nodes are audited all the same.
    other = unit(rng.normal(size=(1024, 32)))
    got = asked(x, other, False)
    assert hnsw_dedup.ask(graph, got)[0] == 128 and not got.links.any() and not got.edges


def test_hot_group_is_counted_without_pairs(monkeypatch):
    """A group of thousands of links each: walked once, then counted by products, never listed."""
    rng = np.random.default_rng(9)
    x = unit(np.concatenate([np.ones((1500, 16)) + rng.normal(0, 0.002, (1500, 16)), rng.normal(size=(1500, 16))])[rng.permutation(3000)])
    listed, beams = [], []
    take, search = hnsw_dedup.Asked.take, hnsw_dedup.Graph.search
    monkeypatch.setattr(hnsw_dedup.Asked, "take", lambda self, rows, nodes: (listed.append(len(rows)), take(self, rows, nodes))[1])
    monkeypatch.setattr(hnsw_dedup.Graph, "search", lambda self, q, beam, least: (beams.append(beam), search(self, q, beam, least))[1])
    got = asked(x, x, True)
    beam, _, brute = hnsw_dedup.ask(hnsw_dedup.Graph(x), got)
    truth = exact_links(x, x, True)
    assert max(listed, default=0) <= hnsw_dedup.BATCH * beam and max(beams) == beam <= 256 and brute >= 1400
    assert (got.links[truth > 1000] == truth[truth > 1000]).all() and len(got.edges) <= 3000
    found = reach(range(3000), [(a // 3, b // 3) for a, b in got.edges])
    assert len({found[i] for i in np.flatnonzero(truth > 1000)}) == 1


def test_graph_answers_nearly_all(spark):
    """Walked, not compared: at most a tenth by brute force, and 0.99 of all links at least."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(5000, 48))
    x[:1500] = x[rng.integers(1500, 5000, 1500)] + rng.normal(size=(1500, 48)) * 0.05
    x[4900:] = x[4900] + rng.normal(size=(100, 48)) * 0.03
    x = unit(x[rng.permutation(5000)])
    got = asked(x, x, True)
    beam, recall, brute = hnsw_dedup.ask(hnsw_dedup.Graph(x), got)
    assert brute <= 500 and recall >= 0.99 and beam <= 256
    assert got.links.sum() >= 0.99 * exact_links(x, x, True).sum() > 5000
    assert (got.links <= exact_links(x, x, True)).all()
    want = reach(range(5000), [(a, b) for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.98, 1)), strict=True)])
    found = reach(range(5000), [(a // 3, b // 3) for a, b in got.edges])
    assert sum(found[i] == want[i] for i in want) >= 0.99 * 5000


def test_isolated_vectors_do_not_widen_the_beam():
    """What counts is links: random vectors, whose nearest nodes are far, are walked with the first beam, and no link is lost."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(4096, 64))
    x[:400] = x[400:800] + rng.normal(size=(400, 64)) * 0.05
    x = unit(x[rng.permutation(4096)])
    got = asked(x, x, True)
    beam, recall, brute = hnsw_dedup.ask(hnsw_dedup.Graph(x), got)
    assert beam == hnsw_dedup.BEAM and recall >= 0.99 and brute <= 100
    truth = exact_links(x, x, True)
    assert truth.sum() >= 800 and got.links.sum() >= 0.99 * truth.sum() and (got.links <= truth).all()


def test_probes_lie_at_the_threshold():
    rng = np.random.default_rng(13)
    x = unit(rng.normal(size=(500, 8)))
    near = (hnsw_dedup._probes(x, 60, 0.98) @ x.T).max(1)
    assert len(near) == 60 and (near >= 0.98).all() and np.median(near) < 0.981
    assert np.allclose(np.abs(hnsw_dedup._probes(np.ones((3, 1)), 3, 0.98)), 1)


@pytest.mark.parametrize("brute", [False, True])
def test_a_link_between_shards_is_counted_on_both_sides(monkeypatch, brute):
    rng = np.random.default_rng(14)
    if brute:
        monkeypatch.setattr(hnsw_dedup, "BEAM", 1 << 20)
    all_of = unit(np.concatenate([np.repeat(rng.normal(size=(300, 32)), 2, axis=0), rng.normal(size=(1400, 32))]) + rng.normal(size=(2000, 32)) * 0.01)
    x, queries = all_of[::2], all_of[1::2]
    weights, copies = rng.integers(1, 4, 1000), rng.integers(1, 4, 1000)
    parts = np.arange(1000), np.arange(1000)
    parts[0][:10] = 0  # connected in their own shard, as are their links below
    parts[1][:10] = 0
    got = hnsw_dedup.Asked(x, np.arange(1000) * 2, copies, queries, np.arange(1000) * 2 + 1, 0.98, weights, parts)
    hnsw_dedup.ask(hnsw_dedup.Graph(x), got)
    near = queries @ x.T >= 0.98
    assert (got.links == near @ copies).all() and (got.back == weights @ near).all()
    # One edge joins the two groups that were connected before.
    assert len(got.edges) == near.sum() - 9 and len(set(got.edges)) == len(got.edges)


def test_vectors_in_many_shards(spark):
    """Every pair of shards is asked, also where a shard has more askers than one task takes."""
    rng = np.random.default_rng(15)
    x = np.repeat(rng.normal(size=(300, 8)), 3, axis=0) + rng.normal(size=(900, 8)) * 0.01
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in hnsw_dedup.find(df, shard_rows=100).collect()}
    near = unit(x) @ unit(x).T >= 0.98
    want = reach(range(900), list(zip(*np.nonzero(np.triu(near, 1)), strict=True)))
    assert all(got[i]["n_links"] == near[i].sum() - 1 and got[i]["component_id"] == want[i] for i in want)
