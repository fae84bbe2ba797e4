"""Queries of the trained operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import gru, langid, quality, templates, toxicity, warc
from tallyfold.llm.parts import fold, read

QUALITY_THRESHOLD = 0.3


def op1_nb_svm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    scored = quality.score(docs, model, ["doc_id"])
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted")
    )


def op9_ngram_bayes_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.train(docs, fold("doc_id", 3) != 1)
    scored = langid.predict(docs, model, ["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op6_conv_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    scored = toxicity.score(docs, model, ["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = templates.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return leaks.select(
        "doc_id", "item_id", "n_found", "n_windows", F.round(F.col("n_found") / F.col("n_windows"), 9).alias("coverage"), "n_changed"
    )


def op8_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.round_trip(read(spark, sf_dir, "pages"))
    return captures.select(
        F.col("page").cast("long").alias("page_id"),
        F.coalesce("response.payload_bytes", "metadata.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").cast("long").alias("refers_to"),
    )


def op2_gru_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = gru.score_documents(docs, fold("doc_id", 5) != 1)
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
