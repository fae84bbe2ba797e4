"""Embedding near-duplicates by hierarchical navigable small-world graphs, one per shard.

A shard is one row: its vectors and its graph, packed. Shards meet as a product of partitions, a shard in each, so an exchange holds one
copy of every vector however many shards there are. Two shards that meet ask each other, and what they find leaves the task as a count
and one edge per vector, not as pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm.parts import components
from tallyfold.runtime import local_frame, lookup_join, release, stage

COSINE = 0.9
NEIGHBOURS = 12  # per node and layer; twice as many on the lowest one
BUILD_BEAM = 48
FIRST_BEAM = 32
# Vectors in one graph, and their bytes in single precision; at least MIN_SHARDS graphs are made, so that work on small tables is spread
# as well.
SHARD_ROWS = 65_536
SHARD_BYTES = 16 << 20
MIN_SHARDS = 6
# A beam takes one step for so many of its places at once.
BEAM_STEP = 32
# Queries searched at once, and the places of their beams; products of vectors, and links, that are held at once.
SEARCH_ROWS = 256
SEARCH_CELLS = 1 << 21
COMPARE_CELLS = 1 << 23
PAIR_ROWS = 1 << 20
# The sample of the audit is cut from this many values of a node's last bits.
DRAWS = 1 << 40
# Audit: so many vectors, taken by hash, are compared with all others, and four times as many until AUDIT_LINKED of them have a link.
# AUDIT_OTHERS of those shall not have the commonest number of links, or one vector in AUDIT_PART is compared. Beams are doubled
# until this share of the links of a vector is found, on average over all and over those with about as many links.
AUDIT_VECTORS = 256
AUDIT_LINKED = 256
AUDIT_OTHERS = 64
AUDIT_PART = 16
AUDIT_RECALL = 0.98
MAX_WIDENINGS = 8


def _select(base: np.ndarray, near: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Per row, up to ``most`` of the candidates ``near`` (sorted by similarity, -1 for none): first those that are nearer to the
    row's vector than to any candidate chosen before, then the nearest others. Returns ids, padded with -1."""
    rows, wide = near.shape
    v = base[np.maximum(near, 0)]
    between = np.einsum("rcd,red->rce", v, v, optimize=True)
    keep = np.zeros((rows, wide), bool)
    for c in range(wide):
        blocked = (keep[:, :c] & (between[:, c, :c] > sims[:, c : c + 1])).any(1)
        keep[:, c] = ~blocked & (near[:, c] >= 0) & (keep.sum(1) < most)
    rank = np.where(near < 0, 2 * wide, np.where(keep, 0, wide)) + np.arange(wide)
    order = np.argsort(rank, axis=1)[:, :most]
    return np.take_along_axis(near, order, 1)


class Graph:
    """Layers of neighbour lists over unit vectors. Searches and insertions work on many vectors at once."""

    def __init__(self, base: np.ndarray, neighbours: int = NEIGHBOURS, seed: int = 1):
        self.base = base
        n = len(base)
        u = np.random.default_rng(seed).random(n)
        self.level = np.minimum(np.floor(-np.log(1 - u) / math.log(neighbours)).astype(int), 6)
        self.width = [2 * neighbours if k == 0 else neighbours for k in range(self.level.max(initial=0) + 1)]
        self.links = [np.full((n, w), -1, np.int32) for w in self.width]
        self.entry = -1

    def _beam(self, q: np.ndarray, start: np.ndarray, layer: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the ``beam`` nodes nearest to each query that a best-first walk finds, sorted."""
        rows = np.arange(len(q))
        ids = np.full((len(q), beam), -1, np.int32)
        sims = np.full((len(q), beam), -np.inf, np.float32)
        k = min(beam, start.shape[1])
        ids[:, :k] = start[:, :k]
        sims[:, :k] = np.where(start[:, :k] >= 0, np.einsum("qd,qkd->qk", q, self.base[np.maximum(start[:, :k], 0)]), -np.inf)
        open_ = ids >= 0
        seen = np.zeros((len(q), len(self.base)), bool)
        at, col = np.nonzero(open_)
        seen[at, ids[at, col]] = True
        live, step = rows, max(1, beam // BEAM_STEP)
        while len(live):
            score = np.where(open_[live], sims[live], -np.inf)
            best = score.argmax(1)[:, None] if step == 1 else np.argpartition(-score, step - 1, axis=1)[:, :step]
            is_open = np.take_along_axis(score, best, 1) > -np.inf
            node = ids[live[:, None], best]
            open_[live[:, None], best] = False
            near = np.where(is_open[:, :, None], self.links[layer][node], -1).reshape(len(live), -1)
            fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
            # A node can stand twice among the neighbours of several, but of none: lists hold distinct ids.
            r, c = np.nonzero(fresh)
            if step > 1:
                _, first = np.unique(r * len(self.base) + near[r, c], return_index=True)
                r, c = r[first], c[first]
                fresh[:] = False
                fresh[r, c] = True
            seen[live[r], near[r, c]] = True
            s = np.full(near.shape, -np.inf, np.float32)
            s[r, c] = np.einsum("ed,ed->e", q[live[r]], self.base[near[r, c]])
            all_s = np.concatenate([sims[live], s], 1)
            all_i = np.concatenate([ids[live], np.where(fresh, near, -1)], 1)
            all_o = np.concatenate([open_[live], fresh], 1)
            top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
            sims[live], ids[live], open_[live] = (np.take_along_axis(x, top, 1) for x in (all_s, all_i, all_o))
            live = live[open_[live].any(1)]
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def _descend(self, q: np.ndarray, to: int) -> np.ndarray:
        start = np.full((len(q), 1), self.entry, np.int32)
        for layer in range(self.level[self.entry], to, -1):
            start, _ = self._beam(q, start, layer, 2)
        return start

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        return self._beam(q, self._descend(q, 0), 0, beam)

    def build(self, beam: int = BUILD_BEAM) -> Graph:
        n, done = len(self.base), 0
        order = np.lexsort((np.arange(n), -self.level))  # upper layers first, so that every layer below is reached
        while done < n:
            new = order[done : done + max(64, min(done, 1024))]
            done += len(new)
            self._insert(new, beam)
        return self

    def _insert(self, new: np.ndarray, beam: int) -> None:
        for layer in range(self.level[new].max(), -1, -1):
            here = new[self.level[new] >= layer]
            q = self.base[here]
            near = np.zeros((len(here), 0), np.int32)
            sims = np.zeros((len(here), 0), np.float32)
            if self.entry >= 0 and layer <= self.level[self.entry]:
                near, sims = self._beam(q, self._descend(q, layer), layer, beam)
            own = q @ q.T  # those inserted together
            np.fill_diagonal(own, -np.inf)
            k = min(beam, len(here) - 1)
            if k > 0:
                part = np.argpartition(-own, k - 1, axis=1)[:, :k]
                near = np.concatenate([near, here[part].astype(np.int32)], 1)
                sims = np.concatenate([sims, np.take_along_axis(own, part, 1)], 1)
            if not near.shape[1]:
                continue
            top = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
            near, sims = np.take_along_axis(near, top, 1), np.take_along_axis(sims, top, 1)
            for lo in range(0, len(here), 512):
                part = slice(lo, lo + 512)
                chosen = _select(self.base, near[part], sims[part], self.width[layer] // (2 if layer == 0 else 1))
                self.links[layer][here[part], : chosen.shape[1]] = chosen
            self._link_back(layer, here)
        top = new[self.level[new].argmax()]
        if self.entry < 0 or self.level[top] > self.level[self.entry]:
            self.entry = int(top)

    def _link_back(self, layer: int, new: np.ndarray) -> None:
        links, wide = self.links[layer], self.width[layer]
        r, c = np.nonzero(links[new] >= 0)
        target, source = links[new[r], c], new[r].astype(np.int32)
        order = np.lexsort((source, target))
        target, source = target[order], source[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for lo in range(0, len(nodes), 512):
            some = slice(lo, lo + 512)
            t, k = nodes[some], count[some]
            extra = np.full((len(t), int(k.max())), -1, np.int32)
            at = np.repeat(np.arange(len(t)), k)
            pos = np.concatenate([np.arange(x) for x in k])
            extra[at, pos] = source[np.repeat(first[some], k) + pos]
            both = np.sort(np.concatenate([links[t], extra], 1), axis=1)[:, ::-1].copy()
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            s = np.where(both >= 0, np.einsum("td,tkd->tk", self.base[t], self.base[np.maximum(both, 0)]), -np.inf).astype(np.float32)
            rank = np.argsort(-s, axis=1, kind="stable")[:, : 4 * wide]
            chosen = _select(self.base, np.take_along_axis(both, rank, 1), np.take_along_axis(s, rank, 1), wide)
            links[t] = -1
            links[t[:, None], np.arange(chosen.shape[1])] = chosen


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    # Scaled by the largest component first: squares of very small or large numbers stay in range.
    v = x.astype(np.float64)
    v /= np.abs(v).max(1)[:, None]
    v /= np.sqrt((v * v).sum(1))[:, None]
    return v, v.astype(np.float32)


def shard_layout(nodes: DataFrame) -> tuple[DataFrame, int]:
    """(``nodes`` with their shard, the number of shards). A shard's vectors of one length are bounded by SHARD_ROWS and SHARD_BYTES;
    lengths that few vectors have share a shard's number."""
    counts = sorted(tuple(r) for r in nodes.groupBy("dim").count().collect())  # one row per length
    even = max(1, math.ceil(sum(n for _, n in counts) / MIN_SHARDS))
    rows, shards, room = [], 0, 0.0
    for dim, n in counts:
        most = max(1, min(even, SHARD_ROWS, SHARD_BYTES // (4 * dim)))
        parts = math.ceil(n / most)
        if parts > 1 or n / most > room:
            shards, room = shards + parts, 1.0 if parts == 1 else 0.0
        room -= n / most if parts == 1 else 0.0
        rows.append((dim, parts, shards - parts))
    sizes = local_frame(nodes.sparkSession, rows, T._parse_datatype_string("dim int, parts int, start int"))
    shard = F.col("start") + F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts")).cast("int")
    return lookup_join(nodes, sizes, ["dim"], "inner").withColumn("shard", shard).drop("parts", "start"), max(1, shards)


PACKED = "dim int, shard int, nodes binary, copies binary, v binary, level binary, links array<binary>"


def _packed(pdf: pd.DataFrame, with_graph: bool) -> pd.DataFrame:
    pdf = pdf.sort_values("node")
    x = np.stack(pdf["v"].to_numpy())
    level, links = b"", []
    if with_graph:
        graph = Graph(_unit(x)[1]).build()
        level, narrow = graph.level.astype(np.int8).tobytes(), np.uint16 if len(x) < 1 << 16 else np.int32
        links = [(layer[graph.level >= k] + 1).astype(narrow).tobytes() for k, layer in enumerate(graph.links)]
    one = {"dim": pdf["dim"].iloc[0], "shard": pdf["shard"].iloc[0], "nodes": pdf["node"].to_numpy(np.int64).tobytes(), "copies": pdf["n"].to_numpy(np.int64).tobytes()}
    return pd.DataFrame([{**one, "v": x.tobytes(), "level": level, "links": links}])


def _pack(nodes: DataFrame, shards: int, with_graph: bool) -> DataFrame:
    dealt = nodes.select("dim", "shard", "node", "n", "v").repartitionById(shards, F.col("shard"))
    return dealt.groupBy("dim", "shard").applyInPandas(lambda pdf: _packed(pdf, with_graph), PACKED)


def build_graphs(nodes: DataFrame, shards: int) -> DataFrame:
    """(dim, shard, nodes, copies, v, level, links): one row per dimension and shard, with the graph of its vectors."""
    return _pack(nodes, shards, True)


class Shard:
    """A packed row: ids and copies of its vectors by position, unit vectors, and the graph if it has one."""

    def __init__(self, dim: int, nodes: bytes, v: bytes, copies: bytes = b"", level: bytes = b"", links: list[bytes] = ()):
        self.nodes, self.copies = np.frombuffer(nodes, np.int64), np.frombuffer(copies, np.int64)
        n = len(self.nodes)
        self.exact, self.single = _unit(np.frombuffer(v, np.float32 if len(v) == 4 * n * dim else np.float64).reshape(n, dim))
        if not level:
            return
        self.graph = Graph(self.single)
        self.graph.level = np.frombuffer(level, np.int8).astype(int)
        self.graph.width = [2 * NEIGHBOURS if k == 0 else NEIGHBOURS for k in range(len(links))]
        self.graph.links = [np.full((n, w), -1, np.int32) for w in self.graph.width]
        for k, layer in enumerate(links):
            here = np.flatnonzero(self.graph.level >= k)
            one = np.frombuffer(layer, np.uint16 if n < 1 << 16 else np.int32).reshape(len(here), -1)
            self.graph.links[k][here] = one.astype(np.int32) - 1
        self.graph.entry = int(self.graph.level.argmax())

    def _checked(self, asked: Shard, x: np.ndarray, y: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        other = asked.nodes[x] != self.nodes[y]
        x, y = x[other], y[other]
        good, some = np.zeros(len(x), bool), max(1, COMPARE_CELLS // self.exact.shape[1])
        for lo in range(0, len(x), some):
            part = slice(lo, lo + some)
            good[part] = np.einsum("ed,ed->e", asked.exact[x[part]], self.exact[y[part]]) >= least
        return x[good], y[good]

    def search(self, asked: Shard, beam: int, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links (position in ``asked``, position here) that the graph finds. A query whose beam is full of links is asked again with
        twice the beam, until its last result is no link or the beam holds the shard. Similarities found in single precision are
        computed again in double precision."""
        todo, wide = np.arange(len(asked.nodes)), min(beam, len(self.nodes))
        while len(todo):
            again, some = [], max(1, min(SEARCH_ROWS, SEARCH_CELLS // wide))
            for lo in range(0, len(todo), some):
                at = todo[lo : lo + some]
                ids, sims = self.graph.search(asked.single[at], wide)
                full = (sims[:, -1] >= least - 1e-4) & (wide < len(self.nodes))
                r, c = np.nonzero((sims >= least - 1e-4) & ~full[:, None])
                yield self._checked(asked, at[r], ids[r, c], least)
                again.append(at[full])
            todo, wide = np.concatenate(again), min(2 * wide, len(self.nodes))

    def compare(self, asked: Shard, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All links (position in ``asked``, position here), by products of matrices."""
        some = max(1, COMPARE_CELLS // len(self.nodes))
        for lo in range(0, len(asked.nodes), some):
            r, c = np.nonzero(asked.single[lo : lo + some] @ self.single.T >= least - 1e-4)
            yield self._checked(asked, lo + r, c, least)


def _product(left: DataFrame, right: DataFrame, lefts: int, rights: int, both_ways: bool) -> DataFrame:
    """Pairs of shards of one dimension, columns ``a_*`` and ``b_*``; each of two different ones once unless ``both_ways``.

    A shard is a partition by its number, and the join reads the partitions pair by pair.
    """
    sides = [
        df.repartitionById(n, F.col("shard")).select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])
        for df, n, side in ((left, lefts, "a"), (right, rights, "b"))
    ]
    on = F.col("a_dim") == F.col("b_dim")
    return sides[0].join(sides[1].hint("shuffle_replicate_nl"), on if both_ways else on & (F.col("a_shard") <= F.col("b_shard")))


def _side(r, side: str, *names: str) -> Shard:
    return Shard(**{c: getattr(r, f"{side}_{c}") for c in ("dim", "nodes", "v", *names)})


def search_graphs(graphs: DataFrame, asked: DataFrame, shards: int, asked_shards: int, beam: int, least: float) -> DataFrame:
    """Pairs (a, b), a < b, with cosine >= ``least`` that packed queries find in any shard's graph."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                q, g = _side(r, "a"), _side(r, "b", "level", "links")
                for x, y in g.search(q, beam, least):
                    both = np.unique(np.sort(np.stack([q.nodes[x], g.nodes[y]], 1), axis=1), axis=0)
                    yield pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})

    pairs = _product(asked.select("dim", "shard", "nodes", "v"), graphs.select("dim", "shard", "nodes", "v", "level", "links"), asked_shards, shards, True)
    return pairs.mapInPandas(find, "a long, b long").distinct()


def block_pairs(graphs: DataFrame, asked: DataFrame, shards: int, asked_shards: int, least: float) -> DataFrame:
    """Links (q, other) from packed queries to all nodes, by blocks of matrix products in double precision."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                q, g = _side(r, "a"), _side(r, "b")
                for x, y in g.compare(q, least):
                    yield pd.DataFrame({"q": q.nodes[x], "other": g.nodes[y]})

    columns = ["dim", "shard", "nodes", "v"]
    return _product(asked.select(*columns), graphs.select(*columns), asked_shards, shards, True).mapInPandas(find, "q long, other long")


def _roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (of every node its own root) with the trees of a[i] and b[i] joined."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]


def merged_links(s: Shard, t: Shard, chunks: Iterator[tuple[np.ndarray, np.ndarray]], cut: int) -> Iterator[pd.DataFrame]:
    """(a, b, others) of the distinct links among ``chunks`` (position in s, position in t): for every node a that has one the copies of
    all nodes it links with, and a node b that links lead to; with ``others`` 0 the links a < b of nodes below ``cut`` themselves."""
    n, wide = len(s.nodes), len(t.nodes)
    kind = np.uint32 if n * wide <= 1 << 32 else np.uint64
    keys = np.concatenate([np.zeros(0, kind), *((x.astype(np.int64) * wide + y).astype(kind) for x, y in chunks)])
    keys.sort()
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    if not len(keys):
        return
    names, copies = np.concatenate([s.nodes, t.nodes]), np.concatenate([s.copies, t.copies])
    others, root = np.zeros(n + wide, np.int64), np.arange(n + wide)
    for lo in range(0, len(keys), PAIR_ROWS):
        x, y = (k.astype(np.int64) for k in divmod(keys[lo : lo + PAIR_ROWS], kind(wide)))
        y += n
        np.add.at(others, x, copies[y])
        np.add.at(others, y, copies[x])
        root = _roots(root, x, y)
        drawn = np.minimum(names[x] & (DRAWS - 1), names[y] & (DRAWS - 1)) < cut
        ends = np.sort(np.stack([names[x[drawn]], names[y[drawn]]], 1), axis=1)
        yield pd.DataFrame({"a": ends[:, 0], "b": ends[:, 1], "others": np.zeros(len(ends), np.int64)})
    at = np.flatnonzero(others)
    yield pd.DataFrame({"a": names[at], "b": names[root[at]], "others": others[at]})


def graph_links(graphs: DataFrame, shards: int, beam: int | None, least: float, cut: int) -> DataFrame:
    """(a, b, others) of every two shards, see :func:`merged_links`: what they find when each asks the other's graph, or without a beam
    all links by blocks."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                same = r.a_shard == r.b_shard
                s = _side(r, "a", "copies", "level", "links")
                t = s if same else _side(r, "b", "copies", "level", "links")
                asks = (lambda g, q: g.compare(q, least)) if beam is None else (lambda g, q: g.search(q, beam, least))
                yield from merged_links(s, t, _met(s, t, asks), cut)

    return _product(graphs, graphs, shards, shards, False).mapInPandas(find, "a long, b long, others long")


def _met(s: Shard, t: Shard, asks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (position in s, position in t), both sides asking; the smaller position first if both are one shard."""
    for x, y in asks(t, s):
        yield (np.minimum(x, y), np.maximum(x, y)) if s is t else (x, y)
    if s is not t:
        for y, x in asks(s, t):
            yield x, y


def audit_links(nodes: DataFrame, graphs: DataFrame, shards: int, total: int, least: float) -> tuple[DataFrame, DataFrame, int, int]:
    """(links (q, other) of a sample of nodes, the packed sample, its shards, the cut below which the sample was drawn): grown until enough
    of it has a link, to all nodes if need be."""
    size = min(AUDIT_VECTORS, total)
    while True:
        cut = size * DRAWS // max(1, total)
        parts = max(1, math.ceil(shards * size / max(1, total)))
        asked = nodes.where(F.pmod("node", F.lit(DRAWS)) < cut).withColumn("shard", F.floor(F.col("shard") * parts / shards).cast("int"))
        asked = stage(_pack(asked, parts, False), "hnsw")
        truth = stage(block_pairs(graphs, asked, shards, parts, least), "hnsw")
        counts = truth.groupBy("q").count().groupBy(F.floor(F.log2("count")).alias("size")).count().toPandas()["count"]
        linked, others = counts.sum(), counts.sum() - counts.max() if len(counts) else 0
        if size >= total or linked >= AUDIT_LINKED and (others >= AUDIT_OTHERS or size * AUDIT_PART >= total):
            return truth, asked, parts, cut
        release(asked)
        release(truth)
        size = min(4 * size, total)


def audit_passes(truth: DataFrame, found: DataFrame) -> bool:
    """Whether ``found`` (a, b) has AUDIT_RECALL of the links of a vector on average, over all vectors in ``truth`` and over those of
    each number of links up to a factor of two. So neither many links of few vectors nor one large group hide what others miss."""
    named = truth.select("q", F.least("q", "other").alias("a"), F.greatest("q", "other").alias("b"))
    per_vector = named.join(found.select("a", "b", F.lit(1).alias("hit")), ["a", "b"], "left").groupBy("q").agg(F.count("*").alias("n"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
    sizes = per_vector.groupBy(F.floor(F.log2("n")).alias("size")).agg(F.count("*").alias("n"), F.avg("recall").alias("recall")).toPandas()
    return not len(sizes) or bool(min((sizes["n"] * sizes["recall"]).sum() / sizes["n"].sum(), sizes["recall"].min()) >= AUDIT_RECALL)


def near_duplicates(
    vectors: DataFrame, least: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", beam: int = FIRST_BEAM,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors link when their cosine in double precision is at least ``least``; those that are null, zero, or hold null
    or non-finite numbers link with nothing, nor do vectors of different length. Equal vectors are one node of the graphs
    and count as links of each other, so one vector that fills a third of the table costs one node. Every node is asked
    in every shard; the beam is widened until an audit of a sample against all vectors finds AUDIT_RECALL of a vector's
    links, and if no beam does, all vectors are compared by blocks. Links of the audit are kept. component_id is the smallest id that links reach; kept marks the row that has it.
    The disk holds each vector three times at most: as a node, in its shard, and in one exchange.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    ok = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # Single precision is kept as it is; tasks widen the numbers again.
    single = dict(vectors.dtypes).get(vector_col) == "array<float>"
    rows = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v"), (F.col(vector_col) if single else v).alias("x"))
    peak = F.array_max(F.transform("v", F.abs))
    valid = rows.where(ok & (F.size("v") > 0)).where(peak > 0)
    # A node is a direction: numbers over the largest of them, which the outer transform works out once.
    scaled = F.transform(F.array(peak), lambda p: F.transform("v", lambda x: x / p + F.lit(0.0)))[0]
    named = valid.select("vec_id", F.col("x").alias("v"), F.xxhash64(scaled).alias("node"))
    nodes = named.groupBy("node").agg(F.first("v").alias("v"), F.count("*").alias("n"), F.min("vec_id").alias("least"))
    nodes = stage(nodes.withColumn("dim", F.size("v")), "hnsw")
    total = nodes.count()
    sizes = stage(nodes.select("node", "n", "least"), "hnsw")
    dealt, shards = shard_layout(nodes)
    graphs = stage(build_graphs(dealt, shards), "hnsw")
    truth, asked, asked_shards, cut = audit_links(dealt, graphs, shards, total, least)
    release(nodes)
    for _ in range(MAX_WIDENINGS + 1):
        if audit_passes(truth, search_graphs(graphs, asked, shards, asked_shards, beam, least)):
            break
        beam *= 2
    else:
        beam, cut = None, 0
    release(asked)
    found = stage(graph_links(graphs, shards, beam, least, cut), "hnsw")
    release(graphs)
    edges, others = found.where("others > 0").select("a", "b"), found.where("others > 0").select("a", "others")
    if cut:  # links of the audit that neither end found
        audited = truth.select(F.least("q", "other").alias("a"), F.greatest("q", "other").alias("b")).distinct()
        lost = stage(audited.join(found.where("others = 0").select("a", "b"), ["a", "b"], "left_anti"), "hnsw")
        ends = lost.union(lost.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = edges.union(lost)
        others = others.union(ends.join(sizes.select(F.col("node").alias("b"), F.col("n").alias("others")), "b").select("a", "others"))
    others = others.groupBy("a").agg(F.sum("others").alias("others"))
    found = components(edges).select("node", "component")
    known = sizes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(names, "component").join(others.select(F.col("a").alias("node"), "others"), "node", "left")
    known = known.select("node", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = named.select("vec_id", "node").join(known, "node").select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(ok & (F.size("v") > 0) & (peak > 0), F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.union(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
