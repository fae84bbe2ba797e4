"""Null groups and classes, clashing column names, and parameters that models do not know."""

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import curves, features, split
from tallyfold.operators.metrics import binary_metrics
from tallyfold.operators.order import average_rank, exact_percentiles, ordered_cumsum
from tallyfold.plans import models
from tallyfold.runtime import lookup_join


def grouped(spark, n=60):
    rows = [(i, None if i % 3 == 0 else f"g{i % 3}", i % 2, float(i % 11) / 10, int(i % 11 > 4)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, g string, y int, p double, label int")


@pytest.mark.parametrize("limit", [5, 10_000])
def test_running_sums_keep_null_groups(spark, limit):
    steps = grouped(spark).groupBy("g", "p").agg(F.count("*").alias("n"))
    got = ordered_cumsum(steps, "p", ["n"], ["g"], leads=["n"], single_window_rows=limit)
    rows = {(r["g"], r["p"]): (r["cum_n"], r["next_n"]) for r in got.collect()}
    expected = {}
    for g in {r["g"] for r in steps.collect()}:
        mine = sorted((r["p"], r["n"]) for r in steps.collect() if r["g"] == g)
        for i, (p, _) in enumerate(mine):
            expected[g, p] = (sum(n for _, n in mine[: i + 1]), mine[i + 1][1] if i + 1 < len(mine) else None)
    assert rows == expected


def test_metrics_have_the_same_groups(spark):
    scores = grouped(spark)
    a = {r["g"] for r in curves.ranking_metrics(scores, ["g"]).collect()}
    b = {r["g"] for r in binary_metrics(scores, ["g"]).collect()}
    c = {r["g"] for r in exact_percentiles(scores, ["p"], [0.5], ["g"]).collect()}
    assert a == b == c == {None, "g1", "g2"}
    assert average_rank(scores, "p", ["g"]).where("avg_rank IS NULL").count() == 0


def test_lookup_join_matches_nulls(spark):
    big = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "id int, `k.x` string")
    small = spark.createDataFrame([(None, 10), ("a", 20)], "`k.x` string, v int")
    for limit in (0, 100):
        got = {r["id"]: r["v"] for r in lookup_join(big, small, ["k.x"], "left", limit=limit).collect()}
        assert got == {1: 10, 2: 20, 3: None}


def test_rows_without_a_class_take_no_place(spark):
    rows = [(i, None if i < 10 else i % 2, "q") for i in range(100)]
    df = spark.createDataFrame(rows, "id int, y int, cuts string")
    done = split.stratified_split(df, ["id"], "y")
    assert done.where("split = 'train'").count() == 45 and done.where("y IS NULL AND split = 'train'").count() == 0
    assert done.columns == ["id", "y", "cuts", "split"]
    folds = split.repeated_folds(df, ["id"], "y", 5, 2)
    assert folds.where("fold IS NULL OR y IS NULL").count() == 0 and folds.count() == 180


def test_features_on_clashing_names(spark):
    names = ("high", "low", "at", "bucket", "n", "value", "column", "cuts")
    rows = [tuple(float((i * (k + 3)) % 17) for k in range(len(names))) for i in range(80)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names))
    for stage in (features.QuantileNormal(cols=list(names)), features.ExactRobustScaler(cols=list(names)), features.MedianImputer(cols=list(names))):
        out = stage.fit(df).transform(df)
        assert out.columns == df.columns and out.count() == 80
        assert out.where(" OR ".join(f"`{n}` IS NULL" for n in names)).count() == 0


def test_unknown_parameters_raise():
    with pytest.raises(ValueError, match="n_estimator"):
        models.model_params("RandomForest", {"n_estimator": 7})
    with pytest.raises(ValueError, match="min_weight"):
        models.model_params("GradientBoosting", {"min_weight_fraction_leaf": 0.5})
    with pytest.warns(UserWarning, match="min_samples_split is ignored"):
        models.model_params("RandomForest", {"min_samples_split": 4})
    assert models.model_params("LogisticRegression", {"l1_ratio": 0.2, "penalty": "elasticnet"})["l1_ratio"] == 0.2


def test_kernel_model_keeps_its_iterations(spark):
    made = models.create_estimator("SVC", {"max_iter": 5000}, models.TrainingFacts(10.0, 3))
    assert made.getMaxIter() == 5000
