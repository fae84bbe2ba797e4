"""Voting and stacking over score frames."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.clean import top_k
from tallyfold.plans.evaluate import Candidate, fold_frames, score_candidates
from tallyfold.plans.foldset import TableSpec, holdout_set
from tallyfold.plans.models import fit_model, score_rows
from tallyfold.runtime import stage


def soft_vote(scores: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., y, p, label): mean probability of the models; exactly one half stays class 0."""
    votes = scores.groupBy(*keys).agg(F.max("y").alias("y"), F.avg("p").alias("p"))
    return votes.withColumn("label", (F.col("p") > 0.5).cast("int"))


def top_bases(comparison: DataFrame, n: int, objective: str = "mcc") -> list[str]:
    return [r["model"] for r in top_k(comparison, f"mean_{objective}", n, "model").collect()]


def _wide(scores: DataFrame, names: list[str]) -> DataFrame:
    """One probability column per base model, assembled as ``features``."""
    columns = [F.max(F.when(F.col("model") == name, F.col("p"))).alias(name) for name in names]
    wide = scores.groupBy("key").agg(F.max("y").alias("y"), *columns)
    return VectorAssembler(inputCols=names, outputCol="features").transform(wide).select("key", "y", "features")


def base_scores(train: DataFrame, test: DataFrame, spec: TableSpec, bases: list[Candidate], seed: int = 42) -> DataFrame:
    """Score frame of the test rows from bases refitted on all training rows."""
    return score_candidates(holdout_set(train, test, spec), bases, seed=seed).select("key", "y", "p", "label", "model")


def stacking(
    train: DataFrame, test: DataFrame, spec: TableSpec, bases: list[Candidate], k: int = 5, seed: int = 42,
    meta: Candidate | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(key, y, p, label) of the test rows, and of the training rows, from a boosted meta-model.

    The meta-model learns from out-of-fold probabilities, and the training rows are scored on them; for prediction the bases are
    refitted on all training rows.
    """
    meta = meta or Candidate("GradientBoosting")
    names = [c.name for c in bases]
    held_out = score_candidates(fold_frames(train, spec, k, 1, seed), bases, seed=seed)
    stacked = stage(_wide(held_out, names), "stacked")
    top = fit_model(meta.model, stacked, meta.params, seed)
    rows = _wide(base_scores(train, test, spec, bases, seed), names)
    tested, learned = (score_rows(top, r).select("key", "y", "p", "label") for r in (rows, stacked))
    return tested, learned


def voting(train: DataFrame, test: DataFrame, spec: TableSpec, bases: list[Candidate], seed: int = 42) -> DataFrame:
    return soft_vote(base_scores(train, test, spec, bases, seed), ["key"])
