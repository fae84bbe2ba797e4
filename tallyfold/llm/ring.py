"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.parts import hash52, repeat_rows
from tallyfold.runtime import stage

RING_BITS = 52
CELL_BITS = 14
# Rows that one ranking group should hold; groups get finer as the table grows.
GROUP_ROWS = 50_000


def ring_points(shards: int, virtual: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, in ring order."""
    at = lambda s, v: int(hashlib.md5(f"shard|{s}|{v}".encode()).hexdigest()[:13], 16)
    return sorted((at(s, v), s) for s in range(shards) for v in range(virtual))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What sharding needs of a document: id, size (UTF-8 bytes and 8) and the crc32 of the text (null: of no bytes)."""
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(body).cast("long") + 8).alias("size"), F.crc32(body).alias("text_crc32")
    )


def ring_shards(rows: DataFrame, shards: int = 24, virtual: int = 64) -> DataFrame:
    """Place every row of ``digest`` on a shard: shard, and slot, which counts from 0 in each shard.

    A key belongs to the arc of the first virtual node at or after its hash. Shard capacities are n / shards, rounded so
    that they add up to n exactly: loads are at most one row apart. Each arc gives its first rows (in ring order) to its
    shard while that has room; the others queue and go clockwise to the next virtual nodes whose shard has room. A
    second lap takes what is queued at the end of the first. When a shard joins or leaves, arcs elsewhere keep their
    rows but for the overflow.

    Only the arc sizes (shards x virtual numbers) are folded one after the other, as one SQL expression. Rows are ranked
    inside narrow slices of the ring whose number follows the table. Repeated rows are counted first and dealt out at
    the end, so a key that fills a third of the table is one row until then. Null ids are hashed by their text; an
    empty table gives no rows. Extra columns of ``rows`` are ignored.
    """
    spark = rows.sparkSession
    points = ring_points(shards, virtual)
    arcs = len(points)
    counted = stage(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n")), "ring")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(40, max(CELL_BITS, math.ceil(math.log2(max(1, total / GROUP_ROWS)))))
    keyed = counted.withColumn(
        "pos", hash52(F.col("doc_id").cast("string"), F.col("text_crc32").cast("string"), F.col("size").cast("string"))
    ).withColumn("cell", F.shiftright("pos", RING_BITS - CELL_BITS))
    placed = keyed.join(F.broadcast(_cells(spark, points)), "cell").where("pos > lo AND pos <= hi")
    placed = placed.withColumn("fine", F.shiftright("pos", RING_BITS - bits)).select(
        "arc", "fine", "pos", "doc_id", "size", "text_crc32", "n"
    )

    groups = placed.groupBy("arc", "fine").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("arc").orderBy("fine").rowsBetween(Window.unboundedPreceding, -1))
    groups = stage(groups.withColumn("group_before", F.coalesce(before, F.lit(0))), "ring")
    flow = stage(_flow(spark, groups, points, total, shards), "ring")

    order = Window.partitionBy("arc", "fine").orderBy("pos", "doc_id", "size", "text_crc32")
    inside = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranked = (
        placed.withColumn("rank0", F.coalesce(inside, F.lit(0)))
        .join(groups.select("arc", "fine", "group_before"), ["arc", "fine"])
        .withColumn("rank0", F.col("rank0") + F.col("group_before"))
    )
    each = repeat_rows(ranked, "n", "copy").withColumn("rank", F.col("rank0") + F.col("copy"))
    out = each.join(F.broadcast(flow), "arc").where("rank >= from_rank AND rank < to_rank")
    return out.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("from_rank")).alias("slot")
    )


def _cells(spark, points: list[tuple[int, int]]) -> DataFrame:
    """(cell, lo, hi, arc): the part of each arc inside each cell, (lo, hi] by position. Its size depends on the ring alone."""
    width = 1 << (RING_BITS - CELL_BITS)
    out, low = [], -1
    for arc, (high, _) in enumerate([*points, ((1 << RING_BITS) - 1, 0)]):
        owner = arc % len(points)  # what lies after the last node belongs to the first
        for cell in range(max(low + 1, 0) // width, high // width + 1):
            out.append((cell, max(low, cell * width - 1), min(high, (cell + 1) * width - 1), owner))
        low = high
    return spark.createDataFrame(out, "cell long, lo long, hi long, arc int")


def _flow(spark, groups: DataFrame, points: list[tuple[int, int]], total: int, shards: int) -> DataFrame:
    """(arc, from_rank, to_rank, shard, base): where each stretch of an arc's ranks goes. At most a few rows per arc."""
    arcs = len(points)
    nodes = spark.createDataFrame([(i, s) for i, (_, s) in enumerate(points)], "arc int, shard int")
    sizes = nodes.join(groups.groupBy("arc").agg(F.sum("n").alias("n")), "arc", "left").fillna(0, ["n"])
    ring = sizes.agg(F.sort_array(F.collect_list(F.struct("arc", "shard", "n"))).alias("nodes"))
    capacity = f"transform(sequence(0, {shards - 1}), s -> {total // shards}L + IF(s < {total % shards}, 1L, 0L))"
    # State: room left by shard, length of the queue, and what each step took of its own rows and of the queue.
    folded = ring.selectExpr(f"""
      aggregate(
        sequence(0, {2 * arcs - 1}),
        named_struct('room', {capacity}, 'queue', 0L,
                     'steps', CAST(array() AS ARRAY<STRUCT<step: INT, arc: INT, shard: INT, own: BIGINT, rest: BIGINT, queued: BIGINT>>)),
        (st, k) -> aggregate(
          array(named_struct('node', nodes[k % {arcs}], 'n', IF(k < {arcs}, nodes[k % {arcs}].n, 0L))), st,
          (s, x) -> named_struct(
            'room', transform(s.room, (r, i) -> IF(i = x.node.shard, r - least(r, x.n + s.queue), r)),
            'queue', s.queue + x.n - least(s.room[x.node.shard], x.n + s.queue),
            'steps', concat(s.steps, array(named_struct(
              'step', k, 'arc', x.node.arc, 'shard', x.node.shard, 'own', least(s.room[x.node.shard], x.n),
              'rest', x.n - least(s.room[x.node.shard], x.n),
              'queued', least(s.queue, s.room[x.node.shard] - least(s.room[x.node.shard], x.n)))))))
      ).steps AS steps""")
    steps = folded.select(F.inline("steps"))
    along = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("rest_before", F.coalesce(F.sum("rest").over(along), F.lit(0)))
    steps = steps.withColumn("queued_before", F.coalesce(F.sum("queued").over(along), F.lit(0)))
    steps = stage(steps, "ring")
    own = steps.where("own > 0").selectExpr("step", "arc", "0L AS from_rank", "own AS to_rank", "shard")
    rests = steps.where("rest > 0").selectExpr("arc", "own", "rest_before AS lo", "rest_before + rest AS hi")
    takes = steps.where("queued > 0").selectExpr("step", "shard", "queued_before AS t_lo", "queued_before + queued AS t_hi")
    moved = rests.join(F.broadcast(takes), F.expr("lo < t_hi AND t_lo < hi")).selectExpr(
        "step", "arc", "own + greatest(lo, t_lo) - lo AS from_rank", "own + least(hi, t_hi) - lo AS to_rank", "shard"
    )
    pieces = own.union(moved)
    base = F.sum(F.col("to_rank") - F.col("from_rank")).over(
        Window.partitionBy("shard").orderBy("step", "arc", "from_rank").rowsBetween(Window.unboundedPreceding, -1)
    )
    return pieces.select("arc", "from_rank", "to_rank", "shard", F.coalesce(base, F.lit(0)).alias("base"))
