"""Small helpers that several of the operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.runtime import stage

# Labels up to this many rows are broadcast (two small columns, about 40 bytes a row in memory); more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, k: int) -> Column:
    """crc32 of the id as text, mod ``k``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % k


def with_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join a narrow table: broadcast if it was counted to have at most ``limit`` rows, else by shuffle."""
    fits = small.limit(limit + 1).count() <= limit
    return big.join(F.broadcast(small) if fits else small, on, how)


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Connected components of an edge list: (node, component), the component named by its smallest node.

    Alternating large-star and small-star steps; each round is written to the shared folder, which cuts the lineage.
    A hub's edges are never gathered: each step is a minimum per node and an equi-join, which adaptive execution splits.
    """
    spark = edges.sparkSession
    now = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges"
    )
    kind = now.schema["u"].dataType
    for _ in range(rounds):
        # Large star: each neighbour above u is tied to the smallest node around u.
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: each neighbour at or below u, and u, to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        same = [f.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first() for f in (now, after)]
        now = after
        if same[0] == same[1]:
            break
    else:
        raise RuntimeError("components did not settle")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots).select(F.col("node").cast(kind), F.col("component").cast(kind))


def hash52(*parts: Column) -> Column:
    """The first 52 bits of the md5 of the parts joined by '|', as a long; null parts are left out."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13), 16, 10).cast("long")


def repeat_rows(df: DataFrame, n: str, index: str, chunk: int = 4096) -> DataFrame:
    """Each row ``n`` times, numbered from 0 in ``index``. Done in two steps, so no row ever holds a long array."""
    whole = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({n} - 1) div {chunk}"))))
    lo = F.col("_chunk") * chunk
    each = whole.withColumn(index, F.explode(F.sequence(lo, F.least(lo + chunk, F.col(n)) - 1)))
    return each.drop("_chunk")
