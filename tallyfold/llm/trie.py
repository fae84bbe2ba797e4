"""Prefix trie of conversations on node tables with minimal perfect hashes.

The digest of a prefix is the exclusive-or of the hashes of its turns and their depths, so it needs no chain along a
conversation. Distinct digests are the nodes. A subtree with a bounded number of rows goes to one shard whole: its nodes get slots
by a minimal perfect hash, counts are scattered into flat arrays, and sums run through an array of parent slots from the deepest
level up. The few nodes above such subtrees, the root among them, are summed by doubling steps over joins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyfold.llm.parts import with_small
from tallyfold.llm.scans import group_scan
from tallyfold.llm.words import mix, release
from tallyfold.runtime import stage

WORD = r"[^\x20\x09-\x0D]+"
SHARD_ROWS = 1 << 17  # rows below a node from which on its subtree is no longer held by one shard
_NODE = [
    ("p1", "long"), ("p2", "long"), ("q1", "long"), ("q2", "long"), ("conv_id", "long"), ("depth", "long"),
    ("n_convs", "long"), ("words", "long"),
]
_SHARD_OUT = (
    "p1 long, p2 long, q1 long, q2 long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long"
)


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit digests: each key has its own slot in 0 .. n - 1.

    On every level the keys left over are hashed into twice as many places; those alone in a place get the next slots, in the order
    of the places, and the others go on. ``slots`` says -1 for what is certainly no key; for other strangers any slot may come
    back, so callers compare the digest kept in that slot.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[np.ndarray] = []
        self.n = 0
        left = np.arange(len(a))
        while len(left):
            size = 2 * len(left) + 1
            place = self._place(a[left], b[left], len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            level = np.full(size, -1, np.int64)
            level[alone] = self.n + np.arange(int(alone.sum()))
            self.n += int(alone.sum())
            self.levels.append(level)
            left = left[~alone[place]]
            if len(self.levels) > 200:
                raise RuntimeError("equal digests among the keys")

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = mix(a + mix(b + np.uint64(level * 2 + 1) * np.uint64(0x9E3779B97F4A7C15)))
        return (h % np.uint64(size)).astype(np.int64)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), -1, np.int64)
        left = np.arange(len(a))
        for k, level in enumerate(self.levels):
            found = level[self._place(a[left], b[left], k, len(level))]
            out[left[found >= 0]] = found[found >= 0]
            left = left[found < 0]
        return out


def sum_shard(node: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Whole subtrees as columns of nodes -> the same in slot order with parents, children, leaves and saved tokens.

    Columns are p1, p2 (digest), q1, q2 (parent's digest), conv_id, depth, n_convs and words; ``parent`` is -1 at a subtree's top.
    """
    u = {c: node[c].view(np.uint64) for c in ("p1", "p2", "q1", "q2")}
    table = PerfectHash(u["p1"], u["p2"])
    slot = table.slots(u["p1"], u["p2"])
    held = {c: np.empty_like(v) for c, v in node.items()}
    for c, v in node.items():
        held[c][slot] = v
    if (held["p1"] != node["p1"][np.argsort(slot)]).any():
        raise RuntimeError("two nodes share a slot")
    parent = table.slots(held["q1"].view(np.uint64), held["q2"].view(np.uint64))
    # A stranger's slot holds another digest: such a parent lies outside.
    at = np.maximum(parent, 0)
    parent[(held["p1"][at] != held["q1"]) | (held["p2"][at] != held["q2"])] = -1
    inner = parent >= 0
    if (held["depth"][parent[inner]] + 1 != held["depth"][inner]).any():
        raise RuntimeError("a digest stands for prefixes of two depths")
    children = np.bincount(parent[inner], minlength=table.n).astype(np.int64)
    leaves = (children == 0).astype(np.int64)
    saved = (held["n_convs"] - 1) * held["words"]
    order = np.argsort(-held["depth"], kind="stable")
    edges = np.flatnonzero(np.diff(held["depth"][order])) + 1
    for level in np.split(order, edges):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    return held | {"parent": parent, "n_children": children, "n_leaves": leaves, "saved_tokens": saved}


def _shards(limit: int):
    """Task function over nodes sorted by subtree: groups of whole subtrees become shards."""
    arrow = to_arrow_schema(T._parse_datatype_string(_SHARD_OUT))

    def give(table: pa.Table) -> pa.RecordBatch:
        done = sum_shard({c: table.column(c).to_numpy() for c, _ in _NODE})
        inner = done["parent"] >= 0
        done["parent_conv_id"] = pa.array(done["conv_id"][done["parent"]], mask=~inner)
        return pa.RecordBatch.from_arrays([pa.array(done[f.name]) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < limit:
                continue
            table = pa.Table.from_batches(held)
            s1, s2 = table.column("s1").to_numpy(), table.column("s2").to_numpy()
            cuts = np.flatnonzero((s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])) + 1
            if len(cuts):
                yield give(table.slice(0, int(cuts[-1])))
                rest = table.slice(int(cuts[-1]))
                held, n = rest.to_batches(), rest.num_rows
        if n:
            yield give(pa.Table.from_batches(held))
        release()

    return run


def turn_table(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, d1, d2, words, uid): turns by 120 bits of the MD5 of role and text. Staged."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit("|"), role, text).cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    return stage(
        conversations.where("conv_id IS NOT NULL").select(
            F.col("conv_id").cast("long").alias("conv_id"), "turn", half(1).alias("d1"), half(16).alias("d2"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("uid"),
        ),
        "turns",
    )


def rebuild(turns: DataFrame, block: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that share opening turns: (rows, conversations).

    Conversation c begins with the first h turns of c - c % block and goes on with its own after the first h; h = crc32(c) % heads.
    Rows are (conv_id, depth, len, d1, d2, words), conversations (conv_id, len); both are staged.
    """
    own = group_scan(turns, "conv_id", [F.col("turn").asc_nulls_first(), "d1", "d2", "uid"])
    sizes = stage(own.groupBy("conv_id").agg(F.max("nth").alias("n")), "sizes")
    plan = sizes.select(
        "conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % block).alias("base"),
    )
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = plan.join(base, "base", "left").withColumn("b", F.least("h", F.coalesce("n_base", F.lit(0))))
    plan = stage(plan.withColumn("len", F.col("b") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "plan")
    later = own.join(plan.select("conv_id", "h", "b", "len"), "conv_id").where("nth > h")
    opening = own.where((F.col("nth") < heads) & (F.col("conv_id") % block == 0)).withColumnRenamed("conv_id", "base")
    opening = opening.join(plan.select("conv_id", "base", "b", "len"), "base").where("nth <= b")
    columns = ["conv_id", "depth", "len", "d1", "d2", "words"]
    rows = later.withColumn("depth", F.col("nth") - F.col("h") + F.col("b")).select(*columns)
    rows = rows.unionByName(opening.withColumn("depth", F.col("nth")).select(*columns))
    return stage(rows, "rebuilt"), plan.select("conv_id", "len")


def ends_digests(ends: DataFrame) -> DataFrame:
    """(p1, p2, conv_id) of conversations where they end -> (p1, p2, ends_sha256).

    Ids are laid out by range, so those of one node may come from many tasks, each of which joins its own into text; the text then
    runs through one hash in the order of the ids, a piece at a time.
    """

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, c = (batch.column(i).to_numpy() for i in range(3))
            first = np.concatenate([[0], np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1])
            ids = c.tolist()
            texts = [",".join(map(str, ids[lo:hi])) for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(ids)])]
            yield pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(c[first]), pa.array(texts)], names=["p1", "p2", "low", "ids"])

    def hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out: list[tuple[int, int, str]] = []
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for node, text in zip(zip(a, b), batch.column(3)):
                if node == key:
                    state.update(b"," + text.as_py().encode())
                    continue
                if state is not None:
                    out.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256(text.as_py().encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["p1", "p2", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, state.hexdigest())], names=["p1", "p2", "ends_sha256"])

    rows = ends.select("p1", "p2", "conv_id")
    pieces = rows.repartitionByRange("p1", "p2", "conv_id").sortWithinPartitions("p1", "p2", "conv_id").mapInArrow(
        join_ids, "p1 long, p2 long, low long, ids string"
    )
    return pieces.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "low").mapInArrow(
        hash_pieces, "p1 long, p2 long, ends_sha256 string"
    )


def _nodes(rows: DataFrame, *by: str) -> DataFrame:
    """Distinct prefixes with their members; one digest for two different prefixes raises.

    A digest stands for one prefix if it has one parent and one last turn: the parent's digest has been checked in the same way.
    """
    same = ["q1", "q2", "depth", "d1", "d2", "words"]
    found = rows.groupBy(*by, "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *[F.min(c).alias(c) for c in same],
        *[F.max(c).alias(f"_{c}") for c in same],
    )
    alike = F.lit(True)
    for c in same:
        alike = alike & (F.col(c) == F.col(f"_{c}"))
    checked = F.when(alike, F.col("depth")).otherwise(F.raise_error(F.lit("a digest stands for two prefixes")).cast("long"))
    return found.withColumn("depth", checked).select(*by, *[F.col(n).cast(t).alias(n) for n, t in _NODE])


def prefix_trie(conversations: DataFrame, block: int = 20, heads: int = 4, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Turns are in the order of ``turn``, null first, ties by the MD5 of role and text; null role and text are empty, equal rows are
    turns of their own. Rows without a conv_id belong to no conversation and are left out. An empty table has no node, not even a
    root. Other columns are not read. No group, be it a conversation, a first turn or the copies of one conversation, is gathered in
    one task; only the ids that end at one node pass one hash, as text.
    """
    rows, convs = rebuild(turn_table(conversations), block, heads)
    hashed = stage(
        rows.withColumns({"v1": F.xxhash64("depth", "d1", "d2"), "v2": F.xxhash64("d2", "depth", "d1", F.lit("second"))}), "hashed"
    )
    scan = group_scan(hashed, "conv_id", ["depth"], "v1", "v2").select(
        "conv_id", "depth", "len", "d1", "d2", "words", F.col("x1").alias("p1"), F.col("x2").alias("p2"),
        F.col("x1").bitwiseXOR(F.col("v1")).alias("q1"), F.col("x2").bitwiseXOR(F.col("v2")).alias("q2"),
    )

    # Nodes with many rows below them are above the shards.
    below = F.sum(F.col("len") - F.col("depth")).alias("below")
    heavy = stage(scan.groupBy("p1", "p2").agg(below).where(F.col("below") >= shard_rows).select("p1", "p2"), "heavy")
    flag = lambda c: heavy.select(F.col("p1").alias(f"{c}1"), F.col("p2").alias(f"{c}2"), F.lit(True).alias(f"high_{c}"))
    marked = with_small(with_small(scan, flag("p"), ["p1", "p2"], "left"), flag("q"), ["q1", "q2"], "left")
    low = marked.where("high_p IS NULL")
    tops = low.where("depth = 1 OR high_q").select("conv_id", F.col("p1").alias("s1"), F.col("p2").alias("s2"))
    nodes = _nodes(low.join(tops, "conv_id"), "s1", "s2")
    shards = stage(nodes.repartition("s1", "s2").sortWithinPartitions("s1", "s2").mapInArrow(_shards(shard_rows), _SHARD_OUT), "shards")

    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("p1"), zero.alias("p2"), F.lit(None).cast("long").alias("q1"), F.lit(None).cast("long").alias("q2"), "conv_id",
        zero.alias("depth"), "n_convs", zero.alias("words"),
    )
    upper = stage(root.unionByName(_nodes(marked.where("high_p"))), "upper")
    upper = _sum_upper(upper, shards.where("parent_conv_id IS NULL"))
    above = upper.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("_above"))
    columns = ["p1", "p2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    tree = shards.unionByName(upper.withColumn("parent_conv_id", F.lit(None).cast("long")))
    tree = with_small(tree, above, ["q1", "q2"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")).select(*columns)

    ends = scan.where("depth = len").select("p1", "p2", "conv_id").unionByName(
        convs.where("len = 0").select(zero.alias("p1"), zero.alias("p2"), "conv_id")
    )
    nothing = hashlib.sha256(b"").hexdigest()
    whole = tree.join(ends_digests(stage(ends, "ends")), ["p1", "p2"], "left")
    return whole.select(*columns[2:], F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def _sum_upper(upper: DataFrame, tops: DataFrame) -> DataFrame:
    """Children, leaves and saved tokens of the nodes above the shards, from the shards' tops (whose parents they are).

    In step k every node adds what its descendants at distance 2^k have gathered, so a chain of n nodes takes log2(n) steps.
    """
    from_low = tops.groupBy("q1", "q2").agg(
        F.count("*").alias("c_low"), F.sum("n_leaves").alias("l_low"), F.sum("saved_tokens").alias("s_low")
    )
    from_high = upper.where("q1 IS NOT NULL").groupBy("q1", "q2").agg(F.count("*").alias("c_high"))
    given = [t.withColumnsRenamed({"q1": "p1", "q2": "p2"}) for t in (from_low, from_high)]
    zero = F.lit(0).cast("long")
    own = upper.join(given[0], ["p1", "p2"], "left").join(given[1], ["p1", "p2"], "left")
    own = own.withColumn("n_children", F.coalesce("c_low", zero) + F.coalesce("c_high", zero))
    now = stage(
        own.select(
            "p1", "p2", "q1", "q2", "conv_id", "depth", "n_convs", "n_children", F.col("q1").alias("a1"), F.col("q2").alias("a2"),
            (F.coalesce("l_low", zero) + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("n_leaves"),
            (F.coalesce("s_low", zero) + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        ),
        "upper",
    )
    deepest = now.agg(F.max("depth")).first()[0] or 0
    for _ in range(deepest.bit_length()):
        far = now.where("a1 IS NOT NULL").groupBy("a1", "a2").agg(F.sum("n_leaves").alias("l_far"), F.sum("saved_tokens").alias("s_far"))
        beyond = now.select(F.col("p1").alias("a1"), F.col("p2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2"))
        summed = now.join(far.withColumnsRenamed({"a1": "p1", "a2": "p2"}), ["p1", "p2"], "left").join(beyond, ["a1", "a2"], "left")
        now = stage(
            summed.withColumns({
                "n_leaves": F.col("n_leaves") + F.coalesce("l_far", zero), "saved_tokens": F.col("saved_tokens") + F.coalesce("s_far", zero),
                "a1": F.col("b1"), "a2": F.col("b2"),
            }).select(*now.columns),
            "upper",
        )
    return now.drop("a1", "a2")
