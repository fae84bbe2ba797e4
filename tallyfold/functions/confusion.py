"""Metric expressions over the four cells of a binary confusion matrix."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Benefit of a true negative, cost of a false positive, cost of a false negative,
# benefit of a true positive; rows are true classes, columns predicted ones.
DEFAULT_COSTS = ((5.0, -2.0), (-10.0, 5.0))

CELLS = ("tp", "fp", "tn", "fn")
LABEL_METRICS = (
    "mcc", "accuracy", "precision", "recall", "f1", "balanced_accuracy", "specificity", "cost_benefit_raw",
    "cost_benefit",
)
# Tuning objectives and the metric each one maximises.
OBJECTIVES = {
    "mcc": "mcc",
    "f1": "f1",
    "balanced_accuracy": "balanced_accuracy",
    "cost_benefit": "cost_benefit_raw",
    "accuracy": "accuracy",
}


def objective_metric(name: str) -> str:
    if name not in OBJECTIVES:
        raise ValueError(f"unknown objective {name!r}; choose one of {sorted(OBJECTIVES)}")
    return OBJECTIVES[name]


def cell_counts(y="y", label="label", suffix: str = "") -> list[Column]:
    """Four conditional sums, one pass, map-side combinable."""
    y, label = _col(y), _col(label)

    def total(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(condition.cast("long")), F.lit(0)).alias(name + suffix)

    return [
        total((y == 1) & (label == 1), "tp"),
        total((y == 0) & (label == 1), "fp"),
        total((y == 0) & (label == 0), "tn"),
        total((y == 1) & (label == 0), "fn"),
    ]


def _ratio(num: Column, den: Column) -> Column:
    """0 where the denominator is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def label_metrics(
    tp="tp", fp="fp", tn="tn", fn="fn", costs=DEFAULT_COSTS, only: tuple[str, ...] = LABEL_METRICS
) -> dict[str, Column]:
    """Metric name -> expression. Cells are doubles before any product, so MCC cannot overflow."""
    tp, fp, tn, fn = (_col(c).cast("double") for c in (tp, fp, tn, fn))
    positives, negatives = tp + fn, tn + fp
    n = positives + negatives
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, positives)
    # One label in truth and prediction together is not a 2x2 matrix: undefined, as is "no negatives".
    one_label = (tn == n) | (tp == n)
    specificity = F.when(one_label | (negatives == 0), F.lit(None).cast("double")).otherwise(tn / negatives)
    balanced = (
        F.when(n == 0, F.lit(None).cast("double"))
        .when(positives == 0, _ratio(tn, negatives))
        .when(negatives == 0, recall)
        .otherwise((recall + tn / negatives) / 2)
    )
    # sqrt factor by factor keeps the product far from the double range limit.
    mcc_den = F.sqrt(tp + fp) * F.sqrt(positives) * F.sqrt(negatives) * F.sqrt(tn + fn)
    (v_tn, v_fp), (v_fn, v_tp) = costs
    raw = tn * v_tn + fp * v_fp + fn * v_fn + tp * v_tp
    best = negatives * v_tn + positives * v_tp
    worst = negatives * v_fp + positives * v_fn
    exprs = {
        "mcc": _ratio(tp * tn - fp * fn, mcc_den),
        "accuracy": _ratio(tp + tn, n),
        "precision": precision,
        "recall": recall,
        "f1": _ratio(2 * precision * recall, precision + recall),
        "balanced_accuracy": balanced,
        "specificity": specificity,
        "cost_benefit_raw": _ratio(raw, n),
        "cost_benefit": normalised_score(raw, best, worst),
    }
    return {name: exprs[name].alias(name) for name in only}


def normalised_score(raw: Column, best: Column, worst: Column) -> Column:
    """(raw - worst) / (best - worst), clipped to [0, 1]; equal ends give 1 or 0."""
    scaled = (raw - worst) / (best - worst)
    return F.when(best == worst, (raw >= best).cast("double")).otherwise(
        F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0))
    )


def check_costs(costs: Mapping[tuple[int, int], float], labels: list) -> None:
    missing = [(a, b) for a in labels for b in labels if (a, b) not in costs]
    if missing or len(costs) != len(labels) ** 2:
        raise ValueError(f"cost matrix does not match the labels {labels}")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
