"""Verdicts and summaries over result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overfit_summary(cv: DataFrame, statistic: str = "median") -> DataFrame:
    """(model, train_acc, val_acc, gap), best validation first. ``cv`` has one row per model and fold."""
    fn = {"median": F.median, "mean": F.avg}[statistic]
    out = cv.groupBy("model").agg(fn("train_acc").alias("train_acc"), fn("val_acc").alias("val_acc"))
    return out.withColumn("gap", F.col("train_acc") - F.col("val_acc")).orderBy(F.desc("val_acc"), "model")


def learning_summary(points: DataFrame, by: list[str]) -> DataFrame:
    """Mean and population std of train and validation scores per training size, with a verdict."""
    stats = [
        fn(c).alias(f"{c}_{n}") for c in ("train", "val") for n, fn in (("mean", F.avg), ("std", F.stddev_pop))
    ]
    return points.groupBy(*by).agg(*stats).withColumn("verdict", fit_verdict("train_mean", "val_mean"))


def fit_verdict(train: str, val: str) -> Column:
    return (
        F.when(F.col(train) - F.col(val) > 0.1, "overfit").when(F.col(val) < 0.5, "underfit").otherwise("well-fitted")
    )


def model_comparison(cv: DataFrame, metrics: list[str], objective: str) -> DataFrame:
    """mean_* and std_* per model, best objective first."""
    stats = [fn(m).alias(f"{n}_{m}") for m in metrics for n, fn in (("mean", F.avg), ("std", F.stddev))]
    return cv.groupBy("model").agg(*stats).orderBy(F.desc(f"mean_{objective}"), "model")


def ensemble_decision(single: DataFrame, ensemble: DataFrame) -> DataFrame:
    """One row: the ensemble is kept only if its MCC is strictly greater; change is in percent."""
    a = single.select(F.lit(1).alias("k"), F.col("model").alias("single_model"), F.col("mcc").alias("single_mcc"))
    b = ensemble.select(F.lit(1).alias("k"), F.col("mcc").alias("ensemble_mcc"))
    change = F.try_divide(
        (F.col("ensemble_mcc") - F.col("single_mcc")) * 100.0, F.abs(F.col("single_mcc"))
    )
    return (
        a.join(b, "k").drop("k").withColumn("change_pct", change)
        .withColumn("keep", F.when(F.col("ensemble_mcc") > F.col("single_mcc"), "ensemble").otherwise(F.col("single_model")))
    )
