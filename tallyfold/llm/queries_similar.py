"""Queries of the similarity operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import hnsw, partenum
from tallyfold.llm.parts import read


def op3_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_components(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_hnsw_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(read(spark, sf_dir, "embeddings")).select(
        F.col("vec_id"), "n_links", F.col("component_id").cast("long").alias("component_id"), "kept"
    )
