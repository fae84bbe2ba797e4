"""Label and probability metrics of score frames ``(key, model, fold, y, p, label)``.

Every label metric of every group comes out of one aggregation to four counts per group.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.confusion import (
    CELLS,
    DEFAULT_COSTS,
    LABEL_METRICS,
    cell_counts,
    check_costs,
    label_metrics,
    normalised_score,
    objective_metric,
)
from tallyfold.runtime import bounded_rows, lookup_join, settle

EPSILON = 2.220446049250313e-16  # fixed value: double machine epsilon


def confusion_matrix(scores: DataFrame, y: str = "y", label: str = "label", labels: list | None = None) -> DataFrame:
    """(y_true, y_pred, n) over all label pairs, absent cells 0."""
    counts = scores.groupBy(F.col(y).alias("y_true"), F.col(label).alias("y_pred")).agg(F.count("*").alias("n"))
    if labels is None:
        counts = settle(counts)
        both = counts.select(F.explode(F.array("y_true", "y_pred")).alias("v")).distinct()
        found = bounded_rows(both)
        if found is None:
            raise ValueError("too many labels for a confusion matrix")
        labels = sorted(r["v"] for r in found)
    kind = scores.schema[y].dataType.simpleString()
    grid = scores.sparkSession.createDataFrame([(a, b) for a in labels for b in labels], f"y_true {kind}, y_pred {kind}")
    return grid.join(counts, ["y_true", "y_pred"], "left").fillna({"n": 0})


def binary_metrics(
    scores: DataFrame, by: list[str] | None = None, costs=DEFAULT_COSTS, only: tuple[str, ...] = LABEL_METRICS,
    y: str = "y", label: str = "label",
) -> DataFrame:
    """All label metrics per group from one grouped aggregation."""
    by = list(by or [])
    cells = scores.groupBy(*by).agg(*cell_counts(y, label))
    return cells.select(*by, *CELLS, *label_metrics(costs=costs, only=only).values())


def cost_benefit(confusion: DataFrame, values: Mapping[tuple, float], by: list[str] | None = None) -> DataFrame:
    """(by..., n, raw, normalised) from a long confusion table, any number of classes."""
    by = list(by or [])
    labels = sorted({a for a, _ in values})
    check_costs(values, labels)
    spark = confusion.sparkSession
    kind = confusion.schema["y_true"].dataType.simpleString()
    rows = [
        (a, b, float(values[a, b]), float(values[a, a]), float(min(values[a, o] for o in labels if o != a)))
        for a in labels
        for b in labels
    ]
    table = spark.createDataFrame(rows, f"y_true {kind}, y_pred {kind}, value double, right double, wrong double")
    valued = lookup_join(confusion, table, ["y_true", "y_pred"], "left")
    unknown = F.sum((F.col("value").isNull() & (F.col("n") > 0)).cast("long"))
    n = F.sum("n").cast("double")
    sums = valued.groupBy(*by).agg(
        n.alias("n"),
        F.sum(F.col("n") * F.col("value")).alias("__raw"),
        F.sum(F.col("n") * F.col("right")).alias("__best"),
        F.sum(F.col("n") * F.col("wrong")).alias("__worst"),
        unknown.alias("__unknown"),
    )
    checked = F.when(
        F.col("__unknown") > 0, F.raise_error(F.lit("cost matrix does not match the labels")).cast("double")
    ).otherwise(F.col("__raw"))
    return sums.select(
        *by,
        F.col("n").cast("long").alias("n"),
        F.when(F.col("n") == 0, 0.0).otherwise(checked / F.col("n")).alias("raw"),
        normalised_score(F.col("__raw"), F.col("__best"), F.col("__worst")).alias("normalised"),
    )


def log_loss_term(y="y", p="p") -> Column:
    p = F.least(F.greatest(F.col(p), F.lit(EPSILON)), F.lit(1.0 - EPSILON))
    return F.when(F.col(y) == 1, -F.log(p)).otherwise(-F.log(F.lit(1.0) - p))


def probability_metrics(scores: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """(by..., n, log_loss, brier)."""
    gap = F.col(p) - F.col(y)
    return scores.groupBy(*(by or [])).agg(
        F.count("*").alias("n"), F.avg(log_loss_term(y, p)).alias("log_loss"), F.avg(gap * gap).alias("brier")
    )


def calibration_curve(
    scores: DataFrame, bins: int = 10, by: list[str] | None = None, y: str = "y", p: str = "p"
) -> DataFrame:
    """(by..., bin, n, mean_p, observed, verdict); equal-width bins, edges join the lower bin."""
    which = F.greatest(F.ceil(F.col(p) * bins) - 1, F.lit(0)).cast("int").alias("bin")
    curve = scores.groupBy(*(by or []), which).agg(
        F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg(F.col(y).cast("double")).alias("observed")
    )
    return curve.withColumn("verdict", calibration_verdict("observed", "mean_p"))


def calibration_verdict(observed: str, mean_p: str) -> Column:
    """Below the diagonal is over-confident, above it under-confident."""
    return (
        F.when(F.col(observed) < F.col(mean_p), "over-confident")
        .when(F.col(observed) > F.col(mean_p), "under-confident")
        .otherwise("calibrated")
    )


def classification_report(confusion: DataFrame, names: dict | None = None) -> DataFrame:
    """(label, precision, recall, f1, support): one row per class, then accuracy and the two averages.

    The confusion table has one row per label pair, so everything after it is tiny.
    """
    right = F.col("n") * (F.col("y_true") == F.col("y_pred")).cast("long")
    by_true = confusion.groupBy(F.col("y_true").alias("c")).agg(F.sum("n").alias("support"), F.sum(right).alias("hit"))
    by_pred = confusion.groupBy(F.col("y_pred").alias("c")).agg(F.sum("n").alias("predicted"))

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b == 0, 0.0).otherwise(a / b)

    hit = F.col("hit").cast("double")
    classes = (
        by_true.join(by_pred, "c", "full")
        .fillna(0, ["support", "hit", "predicted"])
        .withColumn("precision", ratio(hit, F.col("predicted")))
        .withColumn("recall", ratio(hit, F.col("support")))
        .withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )
    label = F.col("c").cast("string")
    if names:
        label = F.create_map(*[F.lit(x) for k, v in names.items() for x in (k, v)])[F.col("c")]
    cols = ("precision", "recall", "f1")
    total = F.sum("support")
    accuracy = F.sum("hit") / total
    rows = [
        classes.select(label.alias("label"), *cols, F.col("support").cast("double").alias("support")),
        # The library's table repeats the accuracy across the row.
        classes.agg(*[accuracy.alias(c) for c in (*cols, "support")]).withColumn("label", F.lit("accuracy")),
        classes.agg(*[F.avg(c).alias(c) for c in cols], total.cast("double").alias("support")).withColumn(
            "label", F.lit("macro avg")
        ),
        classes.agg(
            *[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in cols], total.cast("double").alias("support")
        ).withColumn("label", F.lit("weighted avg")),
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)
