"""Queries of the operators that use DataFrame functions alone, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import mixing, ring
from tallyfold.llm.parts import read

SHARDS, VIRTUAL = 24, 64


def op5_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ring.digest(read(spark, sf_dir, "documents"))
    placed = ring.ring_shards(rows, SHARDS, VIRTUAL)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")
