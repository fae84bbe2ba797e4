"""A corpus pipeline over documents: each stage is written as Parquet and read again for the next.

Quality classifier, near-duplicates, benchmark decontamination, source mix, shards. Every stage works on all rows of its
input and returns the columns of documents; the last one returns the shard and slot of every row of the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import mixing, partenum, quality, ring, templates
from tallyfold.llm.parts import fold, repeat_rows, with_small
from tallyfold.runtime import new_stage_path, stage

QUALITY_THRESHOLD = 0.3


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs do not use."""
    while name in docs.columns:
        name += "_"
    return name


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones outside the held-out fold, does not reject.

    A null text is scored as an empty one. Repeated rows have one score and stay or go together.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, fold("doc_id", 5) != 0)
    name = _free(docs, "_quality")
    scored = quality.with_score(docs, model, name)
    return scored.where(F.col(name) >= QUALITY_THRESHOLD).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the smallest id; of equal rows one. Texts without words all stay."""
    found = stage(partenum.jaccard_components(docs).select("doc_id", "text_key", "n_shingles", "first"), "similar")
    name = _free(docs, "_key")
    key = F.xxhash64("doc_id", "text_key")
    dropped = found.where("NOT first").select(key.alias(name)).distinct()
    repeated = found.where("first AND n_shingles > 0").groupBy(key.alias(name)).agg(F.count("*").alias("n")).where("n > 1").select(name)
    keyed = docs.withColumn(name, F.xxhash64("doc_id", F.xxhash64("text")))
    left = with_small(keyed, dropped, [name], "left_anti")
    if repeated.limit(1).count():
        once = with_small(left, repeated, [name], "left_semi").dropDuplicates([name])
        left = with_small(left, repeated, [name], "left_anti").unionByName(once)
    return left.select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items; equal texts go together, null and empty ones stay."""
    leaks = templates.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    name = _free(docs, "_key")
    keyed = docs.withColumn(name, F.xxhash64("text"))
    leaked = stage(leaks.select(F.col("text_hash").alias(name)).distinct(), "leaks")
    return with_small(keyed, leaked, [name], "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it whole: once per full epoch, and once more if at least half of it is sampled.

    Documents without words take nothing from a source's budget and are sampled by no one, so only full epochs hold them.
    A null source is a source; repeated rows are taken as often as all of them together.
    """
    mixed = mixing.mix(docs)
    times = F.col("epochs") + F.when((F.col("part") > 0) & (F.col("part") * 2 >= F.col("size")), 1).otherwise(0)
    name, many = _free(docs, "_key"), _free(docs, "_times")
    per_row = mixed.groupBy(F.xxhash64("doc_id", "source", "text_crc32").alias(name)).agg(F.sum(times).alias(many), F.count("*").alias("n"))
    per_row = stage(per_row, "mix")
    keyed = docs.withColumn(name, F.xxhash64("doc_id", "source", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))))
    if per_row.where("n > 1").limit(1).count():  # equal rows: one of them, as often as all together
        keyed = keyed.dropDuplicates([name])
    taken = with_small(keyed, per_row.where(F.col(many) > 0).select(name, many), [name])
    return repeat_rows(taken, many, _free(docs, "_copy")).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row."""
    return ring.ring_shards(ring.digest(docs))


STAGES = [
    ("quality", keep_quality),
    ("similar", keep_one_of_each),
    ("leaks", drop_leaks),
    ("mix", mix_sources),
    ("shards", shard),
]
# The classifier and the signatures are not SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        path = new_stage_path(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
