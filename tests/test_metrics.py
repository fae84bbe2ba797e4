"""Worked examples and edge rules of metrics, curves and thresholds."""

import pytest
from pyspark.sql import functions as F

from tallyfold import runtime
from tallyfold.functions.confusion import LABEL_METRICS
from tallyfold.operators import curves, metrics, threshold


def scores(spark, rows, names="y int, label int"):
    return spark.createDataFrame(rows, names)


def test_specificity_example(spark):
    row = metrics.binary_metrics(scores(spark, [(0, 0), (0, 1), (1, 1), (1, 1)])).first()
    assert row["specificity"] == 0.5


def test_cost_examples(spark):
    df = scores(spark, list(zip([0, 0, 1, 1, 1], [0, 1, 1, 1, 0])))
    costs = ((0.0, -1.0), (-10.0, 5.0))
    row = metrics.binary_metrics(df, costs=costs).first()
    assert row["cost_benefit_raw"] == pytest.approx(-0.2)
    assert row["cost_benefit"] == pytest.approx(31 / 47)
    long = metrics.cost_benefit(metrics.confusion_matrix(df), {(0, 0): 0, (0, 1): -1, (1, 0): -10, (1, 1): 5}).first()
    assert long["raw"] == pytest.approx(-0.2) and long["normalised"] == pytest.approx(31 / 47)


def test_cost_matrix_must_fit(spark):
    cm = metrics.confusion_matrix(scores(spark, [(0, 0), (1, 2)]))
    with pytest.raises(ValueError):
        metrics.cost_benefit(cm, {(0, 0): 1.0, (0, 1): 0.0, (1, 1): 1.0})
    with pytest.raises(Exception, match="does not match"):
        metrics.cost_benefit(cm, {(0, 0): 1.0, (0, 1): 0.0, (1, 0): 0.0, (1, 1): 1.0}).collect()


def test_undefined_metrics(spark):
    row = metrics.binary_metrics(scores(spark, [(1, 0), (1, 0)])).first()
    assert (row["precision"], row["recall"], row["f1"], row["mcc"]) == (0.0, 0.0, 0.0, 0.0)
    assert row["specificity"] is None
    assert metrics.binary_metrics(scores(spark, [(0, 0), (0, 0)])).first()["specificity"] is None


def test_unknown_objective():
    with pytest.raises(ValueError):
        metrics.objective_metric("profit")


TIED = [(1, 0.8), (0, 0.4), (1, 0.4), (0, 0.4), (1, 0.35), (0, 0.1)]


@pytest.mark.parametrize("limit", [0, 1000])
def test_average_precision_example(spark, limit):
    df = scores(spark, TIED, "y int, p double")
    row = curves.ranking_metrics(df, single_window_rows=limit or 1).first()
    assert row["pr_auc"] == pytest.approx(0.7) and row["roc_auc"] == pytest.approx(2 / 3)


def many(spark, n=6000):
    p = F.round(F.rand(3), 3)
    return spark.range(n).select(
        "id", (F.col("id") % 3).cast("int").alias("fold"), (F.rand(1) < p).cast("int").alias("y"), p.alias("p")
    )


def test_bucketed_curves_equal_single_window(spark):
    df = many(spark).cache()
    for fn in (curves.ranking_metrics, curves.roc_curve, curves.roc_area):
        small = sorted(fn(df, ["fold"]).collect())
        large = sorted(fn(df, ["fold"], single_window_rows=100).collect())
        assert len(small) == len(large)
        for a, b in zip(small, large):
            assert tuple(a) == pytest.approx(tuple(b))


def test_random_score_has_auc_one_half(spark):
    df = spark.range(20000).select((F.rand(1) < 0.3).cast("int").alias("y"), F.rand(2).alias("p"))
    assert curves.ranking_metrics(df).first()["roc_auc"] == pytest.approx(0.5, abs=0.02)


def test_one_class_has_no_auc(spark):
    row = curves.ranking_metrics(scores(spark, [(1, 0.2), (1, 0.7)], "y int, p double")).first()
    assert row["roc_auc"] is None and row["pr_auc"] == 1.0


def test_sweep_equals_brute_force_on_grid_points(spark):
    step = 1.0 / 100
    rows = [((i * 7) % 3 == 0, i % 101 * step) for i in range(1010)]
    df = scores(spark, [(int(y), p) for y, p in rows], "y int, p double")
    for r in threshold.threshold_sweep(df).collect():
        t = r["threshold"]
        assert r["tp"] == sum(y and p >= t for y, p in rows)
        assert r["fp"] == sum((not y) and p >= t for y, p in rows)


def test_best_threshold_is_lowest_on_ties(spark):
    df = scores(spark, [(0, 0.2), (1, 0.9)], "y int, p double")
    best = threshold.best_threshold(threshold.threshold_sweep(df))
    assert threshold.chosen_threshold(best) == pytest.approx(0.21)
    assert threshold.chosen_threshold(best, "no such metric") == 0.5


def test_threshold_compare_columns(spark):
    df = many(spark, 500).withColumn("model", F.lit("m"))
    best = threshold.best_threshold(threshold.threshold_sweep(df, by=["model"]), ["model"])
    table = threshold.threshold_compare(df, best, ["model"])
    assert {r["metric"] for r in table.collect()} == set(LABEL_METRICS)


def test_distinct_scores_are_counted_in_small_partitions(spark, monkeypatch):
    """A task collapses a bounded part of the scores, however few cores there are; the caller's setting stays."""
    monkeypatch.setattr(curves, "STEP_BYTES", "1m")
    written = []
    monkeypatch.setattr(curves, "stage", lambda *args: written.append(runtime.stage(*args)) or written[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get(runtime.PARTITION_BYTES)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        x = F.xxhash64("id")
        scores = spark.range(2_000_000).select((x % 2 == 0).cast("int").alias("y"), F.rand(3).alias("p"))
        area = curves.roc_area(scores).first()["area"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
    assert len(written[0].inputFiles()) > spark.sparkContext.defaultParallelism + 4
    assert spark.conf.get(runtime.PARTITION_BYTES) == before[1]
    assert abs(area - 0.5) < 0.01
