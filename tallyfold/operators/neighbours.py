"""Exact k nearest neighbours between blocks of a tree, in rounds.

1. Equal vectors collapse to one, keeping the k+1 smallest keys: no other copy can be a neighbour.
2. A tree of cuts, grown on a bounded sample, sends every vector to a leaf; a leaf's vectors are packed once, in blocks of
   bounded size.
3. Each block of queries searches its own leaf, which gives every query a bound on its k-th distance.
4. It then visits, nearest first, the leaves that hold a ball which some of its queries cannot rule out, a few in each round: what
   a round finds shrinks the bounds, and leaves that have fallen out of reach are never visited.

A visit is one row of three numbers. Blocks of near leaves form groups of bounded size, and a task compares one group of queries with
one group of leaves. Where few groups meet, a vector is sent to every group it meets; else each side is dealt out once, a partition per
group, and the tasks are the product of the partitions, so that the disk holds one copy of each side, however many groups there are. A
task keeps the k+1 best of a query as it goes and returns those that beat what the query had. Nothing is approximated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.runtime import local_frame, lookup_join, release, reread, stage

BLOCK_ROWS = 1024
LEAF_ROWS = 1024  # rows that a leaf is meant to hold, as long as there are few enough leaves
MAX_LEAVES = 4096
SAMPLE_PER_LEAF = 16
GROUP_BLOCKS = 64  # blocks of queries, or of leaves, that a task holds at most
GROUPS = 8  # groups that small tables are cut into, so that there are tasks enough
MAX_SENT = 4  # copies of both sides together that an exchange may hold; the product of partitions holds two
REACH_BLOCKS = 4096  # blocks of queries up to which their bounds are broadcast
ROUNDS = (2, 8, MAX_LEAVES)  # leaves that a block of queries visits per round
CHUNK_CELLS = 4_000_000  # numbers held at once per task
# Distances are compared after rounding, so that equal ones tie and the key decides.
DIGITS = 9


def knn(
    queries: DataFrame, base: DataFrame, k: int, key: str = "id", vec: str = "vec",
    n_leaves: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(key, neighbour, rank, dist): the k nearest ``base`` rows of each query, itself excluded.

    Vectors are ``array<double>`` of one length. Ties go to the smaller key.
    """
    keep = k + 1  # a query may meet itself
    first = F.row_number().over(Window.partitionBy("vec").orderBy("key"))
    # row_number <= n becomes a group limit before the shuffle, so many copies stay cheap.
    copies = base.select(F.col(key).alias("key"), F.col(vec).alias("vec")).withColumn("rn", first).where(F.col("rn") <= keep)
    distinct_base = stage(copies.groupBy("vec").agg(F.sort_array(F.collect_list("key")).alias("keys")), "knn_base")
    rows = queries.select(F.col(key).alias("key"), F.col(vec).alias("vec"))
    same = queries is base
    distinct_queries = None if same else stage(rows.groupBy("vec").agg(F.min("key").alias("qid")), "knn_queries")

    n_base = distinct_base.count()
    if not n_base:
        return _empty(rows)
    leaves = n_leaves or int(min(MAX_LEAVES, max(1, n_base // LEAF_ROWS)))
    chosen = distinct_base.select("vec").orderBy(F.xxhash64(F.lit("leaf"), "vec")).limit(leaves * SAMPLE_PER_LEAF).collect()
    tree = grow_tree(np.array([r["vec"] for r in chosen], dtype=float), leaves)
    asks = stage(_first_copies(rows, distinct_base, keep), "asks") if same else rows.join(distinct_queries, "vec").select("key", "qid")
    found, _ = search(distinct_queries, distinct_base, tree, keep, rows.schema["key"].dataType.simpleString(), block_rows)
    pairs = F.explode(F.arrays_zip("qids", "near", "dist")).alias("q")
    lists = found.select(pairs).select(F.col("q.qids").alias("qid"), F.arrays_zip(F.col("q.dist").alias("dist"), F.col("q.near").alias("neighbour")).alias("near"))
    own = asks.join(lists, "qid")
    others = F.slice(F.filter("near", lambda c: c["neighbour"] != F.col("key")), 1, k)
    return own.select("key", F.posexplode(others).alias("pos", "c")).select(
        F.col("key").alias(key), F.col("c.neighbour").alias("neighbour"), (F.col("pos") + 1).alias("rank"), F.col("c.dist").alias("dist")
    )


def _first_copies(rows: DataFrame, distinct: DataFrame, keep: int) -> DataFrame:
    """(key, qid): every row with the smallest key of its vector; only vectors with more copies than ``keys`` can hold are joined."""
    smallest = F.element_at("keys", 1).alias("qid")
    listed = distinct.select(F.explode("keys").alias("key"), smallest)
    full = distinct.where(F.size("keys") >= keep)
    if full.select("keys").isEmpty():
        return listed
    others = rows.join(full.select("vec", "keys", smallest), "vec").where(~F.array_contains("keys", F.col("key")))
    return listed.unionByName(others.select("key", "qid"))


def _empty(rows: DataFrame) -> DataFrame:
    return rows.select("key", F.col("key").alias("neighbour"), F.lit(0).alias("rank"), F.lit(0.0).alias("dist")).where("false")


def grow_tree(sample: np.ndarray, leaves: int) -> list[tuple[np.ndarray, float, int, int]]:
    """Nodes (direction, cut, left, right); a child below 0 is leaf ``-1 - child``.

    A node is cut along the line from one far vector to another, at the widest gap in the middle half, as long as there are leaves
    to fill; the sides get leaves by their share of the vectors.
    """
    nodes: list[tuple[np.ndarray, float, int, int]] = []
    made = 0

    def grow(at: np.ndarray, wanted: int) -> int:
        nonlocal made
        x = sample[at]
        if wanted > 1 and len(x) > 1:
            a = x[np.argmax(((x - x.mean(axis=0)) ** 2).sum(axis=1))]
            b = x[np.argmax(((x - a) ** 2).sum(axis=1))]
            line = (b - a) / max(float(np.linalg.norm(b - a)), 1e-300)
            along = x @ line
            sorted_along = np.sort(along)
            first = len(x) // 4
            gaps = np.diff(sorted_along[first : max(first + 2, len(x) - first)])
            i = first + int(gaps.argmax())
            cut = float((sorted_along[i] + sorted_along[i + 1]) / 2)
            left = along < cut
            if left.any() and not left.all():
                nodes.append((line, cut, 0, 0))
                here = len(nodes) - 1
                share = min(wanted - 1, max(1, round(wanted * float(left.mean()))))
                low, high = grow(at[left], share), grow(at[~left], wanted - share)
                nodes[here] = (line, cut, low, high)
                return here
        made += 1
        return -made

    root = grow(np.arange(len(sample)), leaves)
    return nodes if root >= 0 else []


def _route(x: np.ndarray, tree: list[tuple[np.ndarray, float, int, int]]) -> np.ndarray:
    leaf = np.zeros(len(x), np.int32)
    todo = [(0, np.arange(len(x)))] if tree else []
    while todo:
        node, at = todo.pop()
        line, cut, low, high = tree[node]
        left = x[at] @ line < cut
        for child, rows in ((low, at[left]), (high, at[~left])):
            if child < 0:
                leaf[rows] = -1 - child
            elif len(rows):
                todo.append((child, rows))
    return leaf


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


def _packed(vectors: bytes, n: int) -> np.ndarray:
    return np.frombuffer(vectors).reshape(n, -1)


def _pack(df: DataFrame, tree: list, names: str, schema: str, block_rows: int) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """Blocks of rows that share a leaf: (leaf, block, ``names``, vecs, centre, grp), staged; per leaf its first and last group.

    A block has about ``block_rows`` rows, however many its leaf has. Blocks are numbered along the tree, so that a group's are near
    each other.
    """
    kept = df.columns

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(leaf=_route(_matrix(pdf["vec"]), tree)) if len(pdf) else pdf.assign(leaf=np.zeros(0, np.int32))

    routed = stage(df.mapInPandas(route, f"{schema}, leaf int"), "routed")
    # One row per leaf, at most MAX_LEAVES rows.
    found = sorted(routed.groupBy("leaf").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")).collect())
    total = sum(r["blocks"] for r in found)
    group = min(GROUP_BLOCKS, -(-total // GROUPS)) or 1
    groups, rows, start = {}, [], 0
    for r in found:
        rows.append((r["leaf"], r["blocks"], start, group))
        groups[r["leaf"]] = (start // group, (start + r["blocks"] - 1) // group)
        start += r["blocks"]
    sizes = local_frame(df.sparkSession, rows, T._parse_datatype_string("leaf int, blocks int, start int, size int"))
    dealt = lookup_join(routed, sizes, ["leaf"], "inner").withColumn("block", F.pmod(F.xxhash64("vec"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("grp", F.expr("(start + block) div size").cast("int"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(pdf["vec"])
        centre = x.mean(axis=0)
        one = {"leaf": [pdf["leaf"].iloc[0]], "block": [pdf["block"].iloc[0]], names: [pdf[names].tolist()], "vecs": [x.tobytes()]}
        return pd.DataFrame({**one, "centre": [centre.tolist()], "grp": [pdf["grp"].iloc[0]]})

    kind = next(part for part in schema.split(", ") if part.startswith(names + " ")).split(" ", 1)[1]
    out = f"leaf int, block int, {names} array<{kind}>, vecs binary, centre array<double>, grp int"
    blocks = stage(dealt.select(*kept, "leaf", "block", "grp").groupBy("leaf", "block").applyInPandas(pack, out), "blocks")
    release(routed)
    return blocks, groups


def search(
    queries: DataFrame | None, base: DataFrame, tree: list, keep: int, key_type: str, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, list[DataFrame]]:
    """(blocks of queries with the ``keep`` nearest base rows of each, the visits of every round).

    ``queries`` has (vec, qid), ``base`` (vec, keys), both with distinct vectors. Without ``queries`` the base rows ask, by their first
    key, and are packed once. Tables that :func:`stage` made are deleted when they are packed. Visits are rows (leaf, qleaf, qblock, ...).
    """
    blocks, groups = _pack(base, tree, "keys", f"vec array<double>, keys array<{key_type}>", block_rows)
    release(base)
    if queries is None:
        packed = reread(blocks).withColumn("keys", F.transform("keys", lambda own: own[0])).withColumnRenamed("keys", "qid")
    else:
        packed, _ = _pack(queries, tree, "qid", f"vec array<double>, qid {key_type}", block_rows)
    asked = packed.withColumnsRenamed({"leaf": "qleaf", "block": "qblock", "qid": "qids", "grp": "qgrp"})
    # A ball around each leaf; one row per leaf, at most MAX_LEAVES rows.
    centres = {r["leaf"]: np.array(r["c"]) for r in blocks.groupBy("leaf").agg(F.min_by("centre", "block").alias("c")).collect()}
    radius = _leaf_radii(blocks, centres)
    leaf_ids = np.array(sorted(centres), np.int32)
    middle = np.array([centres[i] for i in leaf_ids])
    extent = np.array([radius[i] for i in leaf_ids])
    state = f"qleaf int, qblock int, qids array<{key_type}>, near array<array<{key_type}>>, dist array<array<double>>, seen array<int>"
    # Within which a query still looks: the distance of the last of its neighbours, if it has them all.
    reach = F.transform("dist", lambda d: F.when(F.size(d) >= keep, F.element_at(d, -1)).otherwise(float("inf"))).alias("reach")

    def plan(step: int | None):
        """Visits of the next ``step`` leaves within reach; without it, of the block's own leaf or the nearest one."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = []
                for r in pdf.itertuples():
                    gap = ball_gaps(_packed(r.vecs, len(r.reach)), middle, extent)
                    if step is None:
                        own = np.flatnonzero(leaf_ids == r.qleaf)
                        pick = own if len(own) else [int(gap.min(axis=0).argmin())]
                    else:
                        open_leaf = (gap <= _widened(r.reach)[:, None]).any(axis=0) & ~np.isin(leaf_ids, r.seen)
                        order = np.argsort(gap.min(axis=0), kind="stable")
                        pick = order[open_leaf[order]][:step]
                    out += [(leaf_ids[j], r.qleaf, r.qblock, r.qgrp, *groups[leaf_ids[j]]) for j in pick]
                yield pd.DataFrame(out, columns=["leaf", "qleaf", "qblock", "qgrp", "low", "high"])

        return run

    def merge(key, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        r = old.iloc[0]
        best = [list(zip(d, n)) for d, n in zip(r["dist"], r["near"])]
        changed = set()
        for v in new.itertuples():
            for q, d, n in zip(v.at, v.dist, v.near):
                best[q] += zip(d, n)
                changed.add(q)
        for q in changed:
            best[q] = sorted(best[q])[:keep]
        seen = sorted({*r["seen"], *(leaf for leaves in new["leaves"] for leaf in leaves)})
        return pd.DataFrame({
            "qleaf": [r["qleaf"]], "qblock": [r["qblock"]], "qids": [r["qids"]],
            "near": [[[n for _, n in b] for b in best]], "dist": [[[d for d, _ in b] for b in best]], "seen": [seen],
        })

    nothing = F.transform("qids", lambda q: F.array().cast(f"array<{key_type}>"))
    far = F.transform("qids", lambda q: F.array().cast("array<double>"))
    now = asked.select("qleaf", "qblock", "qids", nothing.alias("near"), far.alias("dist"), F.array().cast("array<int>").alias("seen"))
    by = ["qleaf", "qblock"]
    vectors = asked.select(*by, "qgrp", "vecs")
    # Vectors stay in their blocks; what the rounds change comes to them.
    looking = asked.select(*by, "qgrp", "vecs", F.transform("qids", lambda q: F.lit(float("inf"))).alias("reach"), F.array().cast("array<int>").alias("seen"))
    all_visits = []
    for step in (None, *ROUNDS):
        if step is not None and len(leaf_ids) == 1:
            break
        if step is not None:
            looking = lookup_join(vectors, now.select(*by, reach, "seen"), by, "inner", REACH_BLOCKS)
        visits = stage(looking.mapInPandas(plan(step), "leaf int, qleaf int, qblock int, qgrp int, low int, high int"), "visits")
        if step is not None and visits.isEmpty():
            break
        all_visits.append(visits)
        found = _compare(visits, looking, blocks, keep, key_type)
        before, now = now, stage(now.groupBy(*by).cogroup(found.groupBy(*by)).applyInPandas(merge, state), "near")
        release(before)
    release(blocks)
    release(packed)
    return now, all_visits


def _widened(reach) -> np.ndarray:
    return np.asarray(reach, dtype=float) * (1 + 1e-9) + 2 * 10.0**-DIGITS


def ball_gaps(x: np.ndarray, middle: np.ndarray, extent: np.ndarray) -> np.ndarray:
    """At most the distance of each row of ``x`` from each ball: the rounding of the product of matrices is taken off."""
    shift = middle.mean(axis=0)
    xc, mc = x - shift, middle - shift
    xx, mm = (xc**2).sum(axis=1)[:, None], (mc**2).sum(axis=1)
    square = xx + mm - 2.0 * (xc @ mc.T) - _slack(xx, mm, x.shape[1])
    return np.maximum(np.sqrt(np.maximum(square, 0.0)) - extent, 0.0)


def _slack(xx: np.ndarray, bb: np.ndarray, dim: int) -> np.ndarray:
    """What rounding may add to a squared distance taken from a product of matrices, per row of ``xx``."""
    return 16 * np.finfo(float).eps * (dim + 2) * (np.sqrt(xx) + np.sqrt(bb.max())) ** 2


def _leaf_radii(blocks: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, float]:
    """The distance of a leaf's farthest vector from the leaf's centre."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            far = [
                float(np.sqrt(((_packed(r.vecs, len(r.keys)) - centres[r.leaf]) ** 2).sum(axis=1).max())) for r in pdf.itertuples()
            ]
            yield pd.DataFrame({"leaf": pdf["leaf"], "far": far})

    found = blocks.select("leaf", "keys", "vecs").mapInPandas(run, "leaf int, far double").groupBy("leaf").agg(F.max("far").alias("far"))
    return {r["leaf"]: r["far"] * (1 + 1e-12) for r in found.collect()}


class Nearest:
    """The ``keep`` nearest rows, of blocks that come one after the other, to each row of ``x``; none beyond its ``reach``.

    One product of matrices rules most rows out, with room for its rounding; the others are measured by differences. ``order`` of a row
    decides between equal distances.
    """

    def __init__(self, x: np.ndarray, reach: np.ndarray, keep: int):
        self.x, self.reach, self.keep = x, np.array(reach, dtype=float), keep
        self.dist = np.full((len(x), keep), np.inf)
        self.row = np.full((len(x), keep), -1)

    def meet(self, b: np.ndarray, order: np.ndarray, first: int) -> None:
        """Compare with the rows ``b``, numbered from ``first`` on."""
        centre = b.mean(axis=0)
        bc = b - centre
        bb = (bc**2).sum(axis=1)
        ball = np.sqrt(bb.max()) * (1 + 1e-12)
        away = ball_gaps(self.x, centre[None], np.array([ball]))[:, 0]
        at = np.flatnonzero(away <= _widened(self.reach))
        step = max(1, CHUNK_CELLS // len(b))
        for lo in range(0, len(at), step):
            self._chunk(at[lo : lo + step], b, bc, bb, centre, order, first)

    def _chunk(self, at, b, bc, bb, centre, order, first) -> None:
        xc = self.x[at] - centre
        xx = (xc**2).sum(axis=1)
        slack = _slack(xx, bb, b.shape[1])
        rough = np.column_stack([-2.0 * xc, np.ones(len(xc))]) @ np.column_stack([bc, bb]).T  # squared distance less xx
        reach = self.reach[at]
        unknown = np.flatnonzero(np.isinf(reach))
        if len(unknown) and len(b) > self.keep:
            kth = np.partition(rough[unknown], self.keep - 1, axis=1)[:, self.keep - 1] + xx[unknown]
            reach[unknown] = np.sqrt(np.maximum(kth, 0.0) + slack[unknown])
        limit = _widened(reach) ** 2 + slack - xx
        i, j = np.nonzero(rough <= limit[:, None])
        if not len(i):
            return
        gap = b[j] - self.x[at[i]]
        d = np.round(np.sqrt(np.einsum("ij,ij->i", gap, gap)), DIGITS)
        near = np.flatnonzero(d <= self.reach[at[i]])
        i, j, d = i[near], j[near], d[near]
        # The new ones of a row with those it had, by distance and order; the first ``keep`` stay.
        met = np.unique(i)
        had_i, had_k = np.nonzero(self.row[at[met]] >= 0)
        rows = np.concatenate([met[had_i], i])
        numbers = np.concatenate([self.row[at[met]][had_i, had_k], j + first])
        dist = np.concatenate([self.dist[at[met]][had_i, had_k], d])
        by = np.lexsort((order[numbers], dist, rows))
        rows, numbers, dist = rows[by], numbers[by], dist[by]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        best = np.flatnonzero(place < self.keep)
        self.row[at[rows[best]], place[best]] = numbers[best]
        self.dist[at[rows[best]], place[best]] = dist[best]
        self.reach[at] = np.minimum(self.reach[at], self.dist[at, -1])

    def found(self, keys: list[list]) -> tuple[list[int], list[list[float]], list[list]]:
        """Rows of ``x`` that met any, with distances and keys; a row of a block stands for all its ``keys``."""
        at, dist, near = np.flatnonzero(self.row[:, 0] >= 0).tolist(), [], []
        for i in at:
            hits = sorted((d, key) for d, j in zip(self.dist[i].tolist(), self.row[i].tolist()) if j >= 0 for key in keys[j])[: self.keep]
            dist.append([h[0] for h in hits])
            near.append([h[1] for h in hits])
        return at, dist, near


def _compare(visits: DataFrame, looking: DataFrame, blocks: DataFrame, keep: int, key_type: str) -> DataFrame:
    """(qleaf, qblock, leaves, at, near, dist): what the visits of a block of queries find in each group of leaves."""
    by, ask = ["qgrp", "grp"], ["qleaf", "qblock", "qgrp"]
    met = visits.withColumn("grp", F.explode(F.sequence("low", "high")))
    asks = met.groupBy(*ask, "grp").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
    needs = met.select("leaf", "grp", "qgrp").distinct()
    counts = {"pairs": by, "asks": [*ask, "grp"], "asking": ask, "needs": ["leaf", "grp", "qgrp"], "needed": ["leaf", "grp"]}
    size = met.agg(*[F.count_distinct(*c).alias(n) for n, c in counts.items()], F.max("qgrp").alias("qlast"), F.max("grp").alias("last")).first()
    bodies = blocks.select("leaf", "grp", "block", "keys", "vecs")
    out = f"qleaf int, qblock int, leaves array<int>, at array<int>, near array<array<{key_type}>>, dist array<array<double>>"

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        b = b.sort_values(["leaf", "block"])
        keys = [list(k) for own in b["keys"] for k in own]
        firsts = np.cumsum([0, *b["keys"].map(len)])
        # A row's place by its smallest key.
        order = np.empty(len(keys), np.int64)
        order[sorted(range(len(keys)), key=lambda i: keys[i][0])] = np.arange(len(keys))
        bodies: dict[int, list] = {}
        for leaf, vecs, first, n in zip(b["leaf"], b["vecs"], firsts, np.diff(firsts)):
            bodies.setdefault(int(leaf), []).append((_packed(vecs, n), int(first)))
        for r in a.itertuples():
            here = [int(leaf) for leaf in r.leaves if int(leaf) in bodies]
            if not here:
                continue
            nearest = Nearest(_packed(r.vecs, len(r.reach)), r.reach, keep)
            for leaf in here:
                for body, first in bodies[leaf]:
                    nearest.meet(body, order, first)
            at, dist, near = nearest.found(keys)
            out.append((r.qleaf, r.qblock, here, at, near, dist))
        return pd.DataFrame(out, columns=["qleaf", "qblock", "leaves", "at", "near", "dist"])

    if size["pairs"] and size["asks"] / size["asking"] + size["needs"] / size["needed"] > MAX_SENT:
        return _product(looking, bodies, met, size["qlast"] + 1, size["last"] + 1).mapInPandas(
            lambda batches: (run(*_sides(r)) for pdf in batches for r in pdf.itertuples()), out
        )
    # Both sides are dealt out anew by a given number: what counts is a task's work, not its bytes.
    tasks = max(1, size["pairs"])
    left = lookup_join(looking, asks, ask, "inner").select(*by, "qleaf", "qblock", "vecs", "reach", "leaves")
    right = lookup_join(bodies, needs, ["leaf", "grp"], "inner")
    left, right = left.repartition(tasks, *by), right.repartition(tasks, *by)
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(run, out)


ASKING, ASKED = ["qleaf", "qblock", "vecs", "reach", "leaves"], ["leaf", "block", "keys", "vecs"]


def _product(looking: DataFrame, bodies: DataFrame, met: DataFrame, qgroups: int, groups: int) -> DataFrame:
    """One row per pair of groups that meet, each group whole: lists ``a_*`` of its blocks of queries, ``b_*`` of its blocks of leaves.

    A group is a partition by its number, so no two share one, and the join without keys reads the partitions pair by pair.
    """
    ask = ["qleaf", "qblock", "qgrp"]
    wanted = met.groupBy(*ask).agg(F.sort_array(F.collect_set("leaf")).alias("leaves"), F.collect_set("grp").alias("grps"))
    left = lookup_join(looking, wanted, ask, "inner").repartitionById(qgroups, F.col("qgrp")).groupBy("qgrp")
    left = left.agg(F.collect_list(F.struct(*ASKING)).alias("a"), F.array_distinct(F.flatten(F.collect_list("grps"))).alias("grps"))
    right = lookup_join(bodies, met.select("leaf", "grp").distinct(), ["leaf", "grp"], "inner").repartitionById(groups, F.col("grp"))
    right = right.groupBy("grp").agg(F.collect_list(F.struct(*ASKED)).alias("b"))
    pairs = left.join(right.hint("shuffle_replicate_nl"), F.array_contains("grps", F.col("grp")))
    return pairs.select(*[F.col(f"a.{c}").alias(f"a_{c}") for c in ASKING], *[F.col(f"b.{c}").alias(f"b_{c}") for c in ASKED])


def _sides(r) -> tuple[pd.DataFrame, pd.DataFrame]:
    """A row of :func:`_product` as the blocks of its two groups."""
    return tuple(pd.DataFrame({c: list(getattr(r, f"{side}_{c}")) for c in names}) for side, names in (("a", ASKING), ("b", ASKED)))
