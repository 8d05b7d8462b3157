"""Near duplicates among vectors: a navigable small-world graph per shard, every shard asked.

Vectors of one label (and length) are dealt into shards of bounded size.  Each shard builds a hierarchical
graph once, which its own vectors walk at once, in batches, and those of the shards before it later: a link
is met from one side and counted on both.  A seeded share of the vectors is also answered by brute force, and
so are probes that lie at the threshold from nodes of the shard: if the walks miss too many links of either,
the beam is doubled.  Cosines decide in double precision, links found are counted where they are found, and
only a spanning forest of them leaves a task.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import components
from marquee.session import materialise

COSINE = 0.98
SHARD_ROWS = 16_384
SHARD_BYTES = 64 << 20
LINKS = 16
BEAM = 32
# Nodes of the top level, nodes inserted or asked at once, and nodes of a beam opened in one step.
TOP_NODES = 64
BATCH = 512
OPENED = 4
# Share of the asking vectors that is audited (at least so many), and the recall wanted of them.
AUDIT_SHARE = 0.02
AUDIT_LEAST = 48
AUDIT_RECALL = 0.99
# Most partitions that shards are dealt to.
MOST_TASKS = 10_000
# Shards that ask another one in one task, which reads its graph once for them.
ASKERS = 4
# Walks go by single precision; what they find this far below the threshold is looked at in double.
SLACK = 1e-4
# A place of a beam that holds no node (it counts as opened), and the bits of a node and of its being opened.
NOWHERE = np.iinfo(np.int64).max
NODE_BITS = np.int64((1 << 32) - 1)


def _placed(cosines: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Numbers that sort as the places of a beam do: the most similar first, then the smaller node; none is opened."""
    bits = cosines.astype(np.float32).view(np.int32)
    bits = ~(bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF)))
    return (bits.astype(np.int64) << 32) | (nodes.astype(np.int64) << 1)


class Graph:
    """Hierarchical navigable small world over unit vectors; more similar is nearer.

    Levels are built from the top: a level begins with the edges of the one above it, and its other nodes
    are inserted in batches.  Each node has edges of its own, in different directions, and room for as
    many of nodes that chose it, the nearest of which stay.
    """

    def __init__(self, vectors: np.ndarray, links: int = LINKS, beam: int = 2 * BEAM, seed: int = 5):
        n = self.n = len(vectors)
        # The row after the last stands for no node.
        self.x = np.concatenate([vectors, np.zeros((1, vectors.shape[1]))]).astype(np.float32)
        self.links = links
        draw = np.random.default_rng(seed).random(n)
        level = np.floor(-np.log(np.maximum(draw, 1e-300)) / math.log(links)).astype(int)
        top = 0
        while np.count_nonzero(level >= top) > TOP_NODES:
            top += 1
        top = max(0, top - 1) if not np.any(level >= top) else top
        self.top = np.flatnonzero(level >= top)
        self.edges: list[np.ndarray] = []
        for below in range(top, -1, -1):
            edges = self.edges[0].copy() if self.edges else np.full((n + 1, 2 * links), n, np.int32)
            self.edges.insert(0, edges)
            known = np.flatnonzero(level > below) if below < top else np.empty(0, int)
            fresh = np.flatnonzero(level == below) if below < top else self.top
            near = np.full((n + 1, links), -np.inf, np.float32)
            if len(known):
                near[known] = self._cosines(self.x[known], edges[known, links:])
            # Batches grow with the graph, so that a node can find those that came shortly before.
            at = 0
            while at < len(fresh):
                step = min(BATCH, max(TOP_NODES, len(known) + at))
                self._insert(fresh[at : at + step], near, beam, at + len(known) > 0)
                at += step

    def state(self) -> tuple:
        return self.n, self.links, self.top, self.edges

    @classmethod
    def restored(cls, state: tuple, vectors: np.ndarray) -> Graph:
        graph = cls.__new__(cls)
        graph.n, graph.links, graph.top, graph.edges = state
        graph.x = np.concatenate([vectors, np.zeros((1, vectors.shape[1]))]).astype(np.float32)
        return graph

    def _cosines(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Of each query with its row of nodes; no node is infinitely far."""
        near = np.matmul(self.x[nodes], q[:, :, None])[:, :, 0]
        near[nodes == self.n] = -np.inf
        return near

    def _insert(self, batch: np.ndarray, near: np.ndarray, beam: int, walked: bool) -> None:
        edges, links, n = self.edges[0], self.links, self.n
        q = self.x[batch]
        inside = q @ q.T
        np.fill_diagonal(inside, -np.inf)
        first = np.argpartition(-inside, min(2 * links, len(batch)) - 1, axis=1)[:, : 2 * links]
        nodes, cosines = batch[first], np.take_along_axis(inside, first, 1)
        if walked:
            found, far = self._descend(q, beam, 0, len(self.edges) > 1)
            nodes, cosines = np.concatenate([found, nodes], 1), np.concatenate([far, cosines], 1)
        order = np.argsort(-cosines, axis=1, kind="stable")[:, : beam + links]
        nodes, cosines = np.take_along_axis(nodes, order, 1), np.take_along_axis(cosines, order, 1)
        own = self._spread(nodes, cosines)
        edges[batch, :links] = own
        # The nodes chosen learn of it: of all that chose them the nearest stay.
        new, old = np.repeat(batch, links), own.ravel()
        new, old = new[old < n], old[old < n]
        close = np.einsum("ij,ij->i", self.x[new], self.x[old])
        order = np.lexsort((-close, old))
        new, old, close = new[order], old[order], close[order]
        place = np.arange(len(old)) - np.searchsorted(old, old)
        touched = np.unique(old)
        row = np.searchsorted(touched, old)
        width = int(min(place.max(initial=-1) + 1, 4 * links))
        some = place < width
        ids, sims = np.full((len(touched), width), n, np.int32), np.full((len(touched), width), -np.inf, np.float32)
        ids[row[some], place[some]], sims[row[some], place[some]] = new[some], close[some]
        ids, sims = np.concatenate([edges[touched, links:], ids], 1), np.concatenate([near[touched], sims], 1)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :links]
        edges[touched, links:] = np.take_along_axis(ids, order, 1)
        near[touched] = np.take_along_axis(sims, order, 1)

    def _spread(self, nodes: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Neighbours in different directions first: one nearer to a chosen neighbour than to the node waits."""
        x = self.x[nodes]
        between = np.matmul(x, x.transpose(0, 2, 1))
        real = near > -np.inf
        chosen = np.zeros(nodes.shape, bool)
        for j in range(nodes.shape[1]):
            hidden = ((between[:, j] > near[:, j, None]) & chosen).any(1)
            chosen[:, j] = real[:, j] & ~hidden & (chosen.sum(1) < self.links)
        waiting = real & ~chosen
        chosen |= waiting & (np.cumsum(waiting, 1) <= (self.links - chosen.sum(1))[:, None])
        order = np.argsort(~chosen, axis=1, kind="stable")[:, : self.links]
        taken = np.where(np.take_along_axis(chosen, order, 1), np.take_along_axis(nodes, order, 1), self.n)
        return np.pad(taken, ((0, 0), (0, self.links - taken.shape[1])), constant_values=self.n)

    def _descend(self, q: np.ndarray, beam: int, level: int, above: bool, hits: list | None = None, least: float = math.inf):
        """The ``beam`` nearest nodes of a level; the levels above it lead to where the walk begins."""
        start = self.top[np.argsort(-(q @ self.x[self.top].T), axis=1, kind="stable")[:, :OPENED]]
        if above:
            for upper in range(len(self.edges) - 1, level, -1):
                start = self._walk(q, start, upper, OPENED)[0]
        return self._walk(q, start, level, beam, hits, least)

    def _walk(self, q: np.ndarray, start: np.ndarray, level: int, beam: int, hits: list | None = None, least: float = math.inf):
        """Best first in all rows at once: ``(nodes, cosines)``, nearest first; ends when all of a beam was opened.

        Whatever is met at ``least`` or above goes to ``hits`` as ``(rows, nodes)``, also beyond the beam.
        A place of a beam is one number that sorts by cosine: the cosine's bits, the node, and whether it was opened.
        """
        edges, wide = self.edges[level], self.n + 1
        seen = np.zeros((len(q), wide), bool)
        seen[:, self.n] = True
        places = np.full((len(q), beam), NOWHERE, np.int64)
        rows, fresh = np.arange(len(q)), start
        while len(rows):
            at = (rows[:, None] * wide + fresh).ravel()
            at = at[~seen.ravel().take(at)]
            at.sort()
            at = at[np.flatnonzero(np.diff(at, prepend=-1))]
            seen.ravel()[at] = True
            # Those of one row lie together.
            ends = np.searchsorted(at, (rows + 1) * wide)
            counts = np.diff(ends, prepend=0)
            asking = np.repeat(rows, counts)
            nodes = at - asking * wide
            close = np.einsum("ij,ij->i", self.x.take(nodes, axis=0), q.take(asking, axis=0))
            if hits is not None:
                met = np.flatnonzero(close >= least)
                hits.append((asking[met], nodes[met]))
            width = beam + int(counts.max(initial=0))
            both = np.full((len(rows), width), NOWHERE, np.int64)
            both[:, :beam] = places[rows]
            both.ravel()[np.arange(len(at)) + np.repeat(np.arange(len(rows)) * width + beam - ends + counts, counts)] = _placed(close, nodes)
            both.sort(axis=1)
            both = both[:, :beam]
            # Places that were not opened yet are even; the nearest of them are next.
            pick = (both & 1) == 0
            pick &= np.cumsum(pick, axis=1) <= OPENED
            places[rows] = both | pick
            who, where = np.nonzero(pick)
            nodes = (both[who, where] & NODE_BITS) >> 1
            counts = pick.sum(axis=1)
            rows, counts = rows[counts > 0], counts[counts > 0]
            opened = np.full((len(rows), OPENED), self.n, np.int64)
            opened[np.repeat(np.arange(len(rows)), counts), np.arange(len(nodes)) - np.repeat(np.cumsum(counts) - counts, counts)] = nodes
            fresh = edges.take(opened, axis=0).reshape(len(rows), OPENED * edges.shape[1])
        ids = np.where(places == NOWHERE, self.n, (places & NODE_BITS) >> 1)
        bits = (~(places >> 32)).astype(np.int32)
        near = (bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))).view(np.float32)
        return ids, np.where(places == NOWHERE, np.float32(-np.inf), near)

    def search(self, q: np.ndarray, beam: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(rows, nodes)`` of what was met at about ``least`` or above, and each row's ``beam`` nearest."""
        hits: list = []
        ids, _ = self._descend(q.astype(np.float32), beam, 0, True, hits, least - SLACK)
        rows, nodes = (np.concatenate([h[i] for h in hits]) for i in (0, 1))
        return rows, nodes, ids


class Asked:
    """Answers of one shard to blocks of vectors: links found, their weights, edges that connect them.

    With ``weights`` of the queries their links are counted at the nodes too (``back``).  ``parts`` are the
    numbers of what is connected already, among the nodes and among the queries.
    """

    def __init__(
        self, x: np.ndarray, ids: np.ndarray, copies: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, least: float,
        weights: np.ndarray | None = None, parts: tuple[np.ndarray, np.ndarray] | None = None,
    ):
        self.x, self.ids, self.copies, self.least = x, ids, copies, least
        self.queries, self.query_ids, self.weights = queries, query_ids, weights
        place = np.minimum(np.searchsorted(ids, query_ids), len(ids) - 1)
        self.own = np.where(ids[place] == query_ids, place, -1)
        self.links = np.zeros(len(queries), np.int64)
        self.back = np.zeros(len(x), np.int64)
        self.edges: list[tuple[int, int]] = []
        # Where each query stands in ``part``, which has the queries behind the nodes if they are others.
        self.part, self.seat = np.arange(len(x)), self.own
        if parts is not None:
            self.part = np.concatenate([parts[0], parts[1] + len(x)])
            self.seat = len(x) + np.arange(len(queries))

    def exact(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(rows, nodes)`` of all links of some queries."""
        near = self.queries[rows] @ self.x.T
        inside = np.flatnonzero(self.own[rows] >= 0)
        near[inside, self.own[rows][inside]] = -np.inf
        r, nodes = np.nonzero(near >= self.least)
        return rows[r], nodes

    def take(self, rows: np.ndarray, nodes: np.ndarray) -> None:
        """Count links given as pairs, verified, and keep the edges that join what was apart."""
        sure = np.einsum("ij,ij->i", self.queries[rows], self.x[nodes]) >= self.least
        sure &= nodes != self.own[rows]
        rows, nodes = rows[sure], nodes[sure]
        np.add.at(self.links, rows, self.copies[nodes])
        if self.weights is not None:
            np.add.at(self.back, nodes, self.weights[rows])
        order = np.argsort(rows, kind="stable")
        rows, nodes = rows[order], nodes[order]
        for group in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(rows)) + 1) if len(rows) else []:
            self._connect(int(rows[group[0]]), nodes[group])

    def take_all(self, rows: np.ndarray) -> None:
        """Count all links of some queries by one product; links are never listed, however many a query has."""
        near = self.queries[rows] @ self.x.T
        slack = 1e-12 * self.x.shape[1]
        linked = near >= self.least - slack
        # At the threshold the sum decides that `take` uses too.
        r, nodes = np.nonzero(linked ^ (near > self.least + slack))
        linked[r, nodes] = np.einsum("ij,ij->i", self.queries[rows[r]], self.x[nodes]) >= self.least
        inside = np.flatnonzero(self.own[rows] >= 0)
        linked[inside, self.own[rows][inside]] = False
        some = np.flatnonzero(linked.any(axis=1))
        # Sums of whole numbers, exact in doubles.
        ones = linked[some].astype(np.float64)
        self.links[rows[some]] += (ones @ self.copies.astype(np.float64)).astype(np.int64)
        if self.weights is not None:
            self.back += (self.weights[rows[some]].astype(np.float64) @ ones).astype(np.int64)
        for i in some:
            self._connect(int(rows[i]), np.flatnonzero(linked[i]))

    def _connect(self, query: int, others: np.ndarray) -> None:
        """Keep the edges of a query that join what was apart."""
        parts, seat = self.part[others], self.seat[query]
        if (parts == parts[0]).all():
            if seat >= 0 and self.part[seat] == parts[0]:
                return
            parts, first = parts[:1], np.zeros(1, int)
        else:
            parts, first = np.unique(parts, return_index=True)
        if seat >= 0:
            apart = parts != self.part[seat]
            parts, first = parts[apart], first[apart]
        self.edges += [(int(self.query_ids[query]), int(self.ids[others[f]])) for f in first]
        if seat >= 0:
            parts = np.append(parts, self.part[seat])
        for part in parts[1:] if len(parts) < 9 else []:
            self.part[self.part == part] = parts[0]
        if len(parts) >= 9:
            self.part[np.isin(self.part, parts[1:])] = parts[0]


def _probes(x: np.ndarray, count: int, least: float) -> np.ndarray:
    """Unit vectors whose cosine to a node each is just above ``least``, in a direction drawn at random."""
    rng = np.random.default_rng(11)
    near = x[np.sort(rng.permutation(len(x))[:count])]
    away = rng.standard_normal(near.shape)
    away -= np.einsum("ij,ij->i", away, near)[:, None] * near
    length = np.linalg.norm(away, axis=1, keepdims=True)
    cosine = least + min(SLACK, (1 - least) / 2)
    # With one component there is no other direction.
    probes = cosine * near + math.sqrt(max(0.0, 1 - cosine * cosine)) * away / np.where(length > 1e-9, length, np.inf)
    return probes / np.linalg.norm(probes, axis=1, keepdims=True)


def ask(graph: Graph, asked: Asked) -> tuple[int, float, int]:
    """Answer all queries: ``(beam, recall of the audit, queries answered by brute force)``.

    The audit wants the links of audited queries, on average over those that have any, and those of as many
    probes at the threshold, so shards without links are audited too and a query with thousands of links
    counts once; the worse of both averages counts.  A query that meets as many links as its beam is wide is
    answered by brute force, which costs it less than wider walks; the audit takes it as found.  A beam
    wider than an eighth of the shard costs more than brute force, which is then used.
    """
    n, total = len(asked.x), len(asked.queries)
    order = np.random.default_rng(7).permutation(total)
    audited = np.sort(order[: max(AUDIT_LEAST, math.ceil(AUDIT_SHARE * total))])
    blocks = lambda rows: np.split(rows, range(BATCH, len(rows), BATCH))
    beam, recall, brute = BEAM, 0.0, len(audited)
    trials = []
    if beam <= n // 8:
        probes = _probes(asked.x, len(audited), asked.least)
        trials = [[(asked.queries[rows], rows, *asked.exact(rows)) for rows in blocks(audited)], []]
        for rows in blocks(np.arange(len(probes))):
            r, nodes = np.nonzero(probes[rows] @ asked.x.T >= asked.least)
            trials[1].append((probes[rows], rows, rows[r], nodes))
    for rows in blocks(audited):
        asked.take_all(rows)
    while beam <= n // 8:
        averages = [_shares(graph, trial, beam, asked.least) for trial in trials]
        recall = min((float(np.mean(shares)) for shares in averages if shares), default=1.0)
        if recall >= AUDIT_RECALL:
            break
        beam *= 2
    rest = np.setdiff1d(np.arange(total), audited)
    if beam <= n // 8 and len(rest):
        again = []
        for rows in blocks(rest):
            r, nodes, _ = graph.search(asked.queries[rows], beam, asked.least)
            full = np.bincount(r, minlength=len(rows)) >= beam
            again.append(rows[full])
            asked.take(rows[r[~full[r]]], nodes[~full[r]])
        rest = np.concatenate(again)
    brute += len(rest)
    for rows in blocks(rest):
        asked.take_all(rows)
    return beam, recall if beam <= n // 8 else 1.0, brute


def _shares(graph: Graph, trial: list, beam: int, least: float) -> list[float]:
    """Of each vector of a trial that has links, the share of them that a walk meets."""
    shares = []
    for vectors, rows, linked, nodes in trial:
        r, found, _ = graph.search(vectors, beam, least)
        full = np.bincount(r, minlength=len(rows)) >= beam
        for i, row in enumerate(rows):
            wanted = nodes[linked == row]
            if len(wanted):
                shares.append(1.0 if full[i] else float(np.isin(wanted, found[r == i]).mean()))
    return shares


ANSWER_DDL = "id long, n long, other long, recall double, beam int, brute double"


def _answers(ids: np.ndarray, links: np.ndarray, edges: list, recall: float, beam: int, brute: float) -> pd.DataFrame:
    """A row for each vector with its links, and a row for each edge."""
    ends = np.asarray(sorted(set(edges)), np.int64).reshape(-1, 2)
    counted = pd.DataFrame({"id": ids, "n": pd.array(links, "Int64"), "other": pd.array([None] * len(ids), "Int64")})
    joined = pd.DataFrame({"id": ends[:, 0], "n": pd.array([None] * len(ends), "Int64"), "other": pd.array(ends[:, 1], "Int64")})
    return pd.concat([counted, joined], ignore_index=True).assign(recall=recall, beam=beam, brute=brute)


def _build(cosine: float):
    def one(rows: pd.DataFrame) -> pd.DataFrame:
        """One shard: its graph, walked by its own vectors; for others also that and ids, weights, unit vectors, parts."""
        rows = rows.sort_values("id")
        x = np.stack([np.asarray(v, np.float64) for v in rows["embedding"]])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        ids, copies = rows["id"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64)
        first = rows.iloc[0]
        graph, asked = Graph(x), Asked(x, ids, copies, x, ids, cosine)
        beam, recall, brute = ask(graph, asked)
        made = _answers(ids, asked.links, asked.edges, recall, beam, brute / len(ids))
        made = made.assign(label=first["label"], dim=first["dim"], shard=first["shard"], shards=first["shards"], graph=None, nodes=None)
        if first["shards"] > 1:
            nodes = (ids, copies, x, asked.part)
            blobs = made.iloc[:1].assign(id=None, n=None, other=None, graph=[pickle.dumps(graph.state(), protocol=5)], nodes=[pickle.dumps(nodes, protocol=5)])
            made = pd.concat([made.astype({"id": "Int64"}), blobs.astype({"id": "Int64", "n": "Int64", "other": "Int64"})], ignore_index=True)
        return made

    return one


def _ask(cosine: float):
    def some(task: pd.DataFrame) -> pd.DataFrame:
        """All vectors of a few shards against the graph of one shard."""
        row = task[task["graph"].notna()].iloc[0]
        ids, copies, x, part = pickle.loads(row["nodes"])
        graph = Graph.restored(pickle.loads(row["graph"]), x)
        answers = []
        for blob in task.loc[task["graph"].isna(), "nodes"]:
            query_ids, weights, queries, own_part = pickle.loads(blob)
            asked = Asked(x, ids, copies, queries, query_ids, cosine, weights, (part, own_part))
            beam, recall, brute = ask(graph, asked)
            brute /= len(queries)
            answers.append(_answers(query_ids, asked.links, asked.edges, recall, beam, brute))
            answers.append(_answers(ids, asked.back, [], recall, beam, brute))
        return pd.concat(answers, ignore_index=True)

    return some


def find(vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding", label: str = "label",
         shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept, recall, beam, brute)`` of every row of ``vectors``.

    Rows of one label (not null) and one vector length are compared; links have a cosine of ``cosine`` or
    more.  ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest key
    reachable, ``kept`` says that it is the row's own.  A vector that is null, zero, or holds null or
    non-finite numbers, or whose label is null, links with nothing.  Equal vectors are one node with a
    weight, so copies are never paired.  Repeated keys stay rows of their own; a null key counts as larger
    than any other; an empty table gives no rows.  ``recall`` (the least audited), ``beam`` (the widest) and
    ``brute`` (the largest share answered by brute force) are those of the shards that a row's vector asked or
    that asked its own; null where there are none.
    """
    rows = materialise(vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("key"), F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("embedding"),
    ), "vectors")
    finite = F.forall("embedding", lambda v: F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    usable = F.col("label").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    marked = rows.withColumn("usable", usable)
    nodes = marked.where("usable").groupBy("label", "embedding").agg(
        F.min("row").alias("id"), F.count("*").alias("copies"), F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("first")
    ).withColumn("dim", F.size("embedding"))
    nodes = materialise(nodes, "nodes")
    fits = F.least(F.lit(shard_rows), F.greatest(F.lit(1), F.floor(F.lit(SHARD_BYTES) / (F.col("dim") * 8))))
    shards = nodes.groupBy("label", "dim").agg(F.count("*").alias("n")).withColumn("shards", F.ceil(F.col("n") / fits))
    shards = materialise(shards, "shards")
    count = shards.agg(F.sum("shards"), F.sum(F.expr("shards * (shards - 1)"))).first()
    dealt = nodes.join(shards, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int"))
    place = ["label", "dim", "shard"]
    # A few shards to a partition at most, so that no task gets many of them by chance.
    spread = lambda df, groups, *by: df.repartition(int(min(MOST_TASKS, max(1, 2 * groups))), *by)
    graphs = spread(dealt.select(*place, F.col("shards").cast("int"), "id", "copies", "embedding"), count[0] or 0, *place).groupBy(*place).applyInPandas(
        _build(cosine), f"{ANSWER_DDL}, label string, dim int, shard int, shards int, graph binary, nodes binary"
    )
    graphs = materialise(graphs, "graphs")
    answers = graphs.where("id IS NOT NULL").select("id", "n", "other", "recall", "beam", "brute")
    if count[1]:
        # Each shard is asked by those before it, a few to a task.
        blobs = graphs.where("graph IS NOT NULL")
        to = F.explode(F.sequence(F.col("shard") + 1, F.col("shards") - 1)).alias("to")
        askers = blobs.where("shard < shards - 1").select("label", "dim", to, F.floor(F.col("shard") / ASKERS).cast("int").alias("part"), F.lit(None).cast("binary").alias("graph"), "nodes")
        parts = F.explode(F.sequence(F.lit(0), F.floor((F.col("shard") - 1) / ASKERS).cast("int"))).alias("part")
        asked = blobs.where("shard > 0").select("label", "dim", F.col("shard").alias("to"), parts, "graph", "nodes")
        by = ["label", "dim", "to", "part"]
        # At most so many tasks: a shard's askers fill all of its tasks but one.
        tasks = spread(askers.union(asked), -(-count[1] // ASKERS), *by)
        answers = answers.union(materialise(tasks.groupBy(*by).applyInPandas(_ask(cosine), ANSWER_DDL), "answers"))
    linked = answers.where("n IS NOT NULL").groupBy("id").agg(
        F.sum("n").alias("n"), F.min("recall").alias("recall"), F.max("beam").alias("beam"), F.max("brute").alias("brute")
    )
    found = components(answers.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    placed = nodes.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    heads = placed.groupBy("component").agg(F.min("first").alias("head"))
    named = placed.join(heads, "component").join(linked, "id").select(
        "label", "embedding", (F.col("n") + F.col("copies") - 1).alias("n_links"), F.col("head.key").alias("component_id"),
        "recall", "beam", "brute",
    )
    inside = marked.where("usable").join(named, ["label", "embedding"])
    none = [F.lit(None).cast(kind).alias(c) for c, kind in (("recall", "double"), ("beam", "int"), ("brute", "double"))]
    alone = marked.where("NOT usable").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"), *none)
    return inside.select("key", "n_links", "component_id", "recall", "beam", "brute").union(alone).select(
        F.col("key").alias("vec_id"), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
        "recall", "beam", "brute",
    )
