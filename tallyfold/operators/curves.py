"""ROC and precision-recall curves and the areas under them, tie-exact and without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.order import SINGLE_WINDOW_ROWS, ordered_cumsum
from tallyfold.runtime import lookup_join, settle, stage

# Shuffled bytes of distinct scores per task: some 400,000 of them, whose hash map stays small and does not spill.
STEP_BYTES = "4m"


def score_steps(
    scores: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p",
    leads: list[str] | None = None, single_window_rows: int = SINGLE_WINDOW_ROWS,
) -> DataFrame:
    """One row per distinct score, best first: (by..., score, pos, neg, cum_pos, cum_neg, p_all, n_all).

    Rows collapse to distinct scores before any ordering, with partial sums on the map side.
    """
    by = list(by or [])
    one = stage(scores.where(F.col(p).isNotNull()).groupBy(*by, F.col(p).alias("score")).agg(
        F.sum(F.col(y).cast("long")).alias("pos"), F.sum((1 - F.col(y)).cast("long")).alias("neg")
    ), "steps", STEP_BYTES)
    steps = ordered_cumsum(one, "score", ["pos", "neg"], by, True, leads, single_window_rows)
    totals = settle(one.groupBy(*by).agg(F.sum("pos").alias("p_all"), F.sum("neg").alias("n_all")))
    if by:
        return lookup_join(steps, totals, by, "inner")
    row = totals.first()
    return steps.withColumns({"p_all": F.lit(row["p_all"]), "n_all": F.lit(row["n_all"])})


def _or_null(condition, value):
    return F.when(condition, value)


def ranking_metrics(scores: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p", **kw) -> DataFrame:
    """(by..., roc_auc, pr_auc): rank-sum AUC with ties at one half, and step-wise average precision.

    AUC is null with one class; average precision is 0 without positives.
    """
    steps = score_steps(scores, by, y, p, **kw)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    above = F.col("cum_pos") - F.col("pos") + pos / 2
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    pairs = F.first("p_all").cast("double") * F.first("n_all")
    positives = F.first("p_all").cast("double")
    return steps.groupBy(*(by or [])).agg(
        _or_null(pairs > 0, F.sum(neg * above) / pairs).alias("roc_auc"),
        F.when(positives > 0, F.sum(pos * precision) / positives).otherwise(F.lit(0.0)).alias("pr_auc"),
    )


def roc_curve(
    scores: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p", drop_collinear: bool = True, **kw
) -> DataFrame:
    """(by..., threshold, fpr, tpr) from (inf, 0, 0) on; points on a straight line can be dropped."""
    by = list(by or [])
    steps = score_steps(scores, by, y, p, leads=["pos", "neg"] if drop_collinear else None, **kw)
    if drop_collinear:
        # A point is kept when it is first or last, or when the next step differs from its own.
        first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        bend = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        steps = steps.where(first | F.col("next_pos").isNull() | bend)
    fpr = _or_null(F.col("n_all") > 0, F.col("cum_neg") / F.col("n_all"))
    tpr = _or_null(F.col("p_all") > 0, F.col("cum_pos") / F.col("p_all"))
    points = steps.select(*by, F.col("score").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))
    groups = points.select(*by).distinct() if by else points.sparkSession.range(1)
    start = groups.select(
        *by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def pr_curve(scores: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p", **kw) -> DataFrame:
    """(by..., threshold, precision, recall) plus the closing point (null, 1, 0)."""
    by = list(by or [])
    steps = score_steps(scores, by, y, p, **kw)
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    recall = F.when(F.col("p_all") > 0, F.col("cum_pos") / F.col("p_all")).otherwise(1.0)
    points = steps.select(*by, F.col("score").alias("threshold"), precision.alias("precision"), recall.alias("recall"))
    groups = points.select(*by).distinct() if by else points.sparkSession.range(1)
    end = groups.select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def roc_area(scores: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p", **kw) -> DataFrame:
    """Trapezoid area under the ROC steps: each step adds width * mean height, no look-back needed."""
    steps = score_steps(scores, by, y, p, **kw)
    width = F.col("neg") / F.col("n_all")
    height = (F.col("cum_pos") - F.col("pos") / 2) / F.col("p_all")
    defined = (F.col("n_all") > 0) & (F.col("p_all") > 0)
    return steps.groupBy(*(by or [])).agg(F.sum(_or_null(defined, width * height)).alias("area"))
