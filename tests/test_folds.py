"""Preprocessing of all fold complements at once, and regressions fitted together, against one fit per fold."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyfold.operators import folds, split
from tallyfold.operators.features import feature_names, preprocessing
from tallyfold.plans import evaluate, foldset, linear, model_queries, models
from tallyfold.plans.evaluate import Candidate, TableSpec
from tallyfold.runtime import stage

SPEC = TableSpec("id", ("a", "b", "tied"), ("c", "d"))


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(700):
        a, b = float(rng.normal()), float(rng.exponential(30))
        y = None if i % 101 == 7 else int(a + b / 40 + rng.normal() * 0.8 > 1.3)
        c = "rare" if i == 55 else str(rng.choice(["u", "v", "w"]))
        b = None if rng.random() < 0.3 else float("nan") if rng.random() < 0.05 else b
        rows.append((i, a, b, float(rng.integers(0, 3)), None if rng.random() < 0.1 else c, f"{i % 4}é", y))
    df = spark.createDataFrame(rows, "id long, a double, b double, tied double, c string, d string, y int")
    return stage(df.repartition(5))


@pytest.fixture(scope="module")
def folded(table):
    return foldset.fold_set(table, SPEC, 3, 2)


def test_fold_array_is_repeated_folds(table, folded):
    got = {(r["key"], i + 1): f for r in folded.rows.collect() for i, f in enumerate(r["folds"])}
    rows = split.repeated_folds(table, ["id"], "y", 3, 2).collect()
    assert got == {(r["id"], r["repeat"]): r["fold"] for r in rows}


def states(stages):
    return [s.getOrDefault("state") for s in stages if hasattr(s, "state")]


def test_all_cells_equal_a_fit_per_fold(folded):
    for cell in folded.cells:
        one = preprocessing(list(SPEC.nums), list(SPEC.cats)).fit(folded.training_rows(cell))
        assert states(one.stages) == states(folded.pipeline(cell).stages)
        names = [feature_names(m, list(SPEC.nums), list(SPEC.cats)) for m in (one, folded.pipeline(cell))]
        assert names[0] == names[1]
        x = [{r["key"]: tuple(r["v"]) for r in f.select("key", vector_to_array("features").alias("v")).collect()}
             for f in (one.transform(folded.rows), folded.frame(cell))]
        assert x[0] == x[1]


def test_brackets_give_the_same(spark, folded):
    """With a coarse sketch only values near the quartiles are counted one by one."""
    big = spark.range(60_000).select(
        F.array((F.col("id") % 3 + 1).cast("int")).alias("folds"), (F.xxhash64("id") / 1e15).alias("v"),
        F.when(F.rand(3) < 0.5, F.xxhash64("id", F.lit(1)) / 1e15).alias("half"),
    )
    rows, cells = stage(big), folds.cells_of(3, 1)
    assert folds.complement_quartiles(rows, ["v", "half"], cells, 1000) == folds.complement_quartiles(rows, ["v", "half"], cells, 20_000)


def test_columns_without_values_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None, None, [1])], "id long, a double, c string, folds array<int>")
    assert folds.complement_quartiles(df, ["a"], [(1, 2)]) == {(1, 2): {}} and folds.complement_categories(df, ["c"], [(1, 2)]) == {(1, 2): {}}
    assert folds.complement_table(df.limit(0), ["a"], ["c"], [(1, 1)]).count() == 0


REGRESSIONS = [
    Candidate("LogisticRegression", {"C": c, "class_weight": w}, s, f"{c} {w} {s}")
    for c, w, s in [(0.05, None, "none"), (3.0, "balanced", "none"), (1.0, None, "random_undersample"), (2.0, "balanced", "random_oversample")]
]


def test_regressions_equal_single_fits(folded):
    found = {(m.name, m.cell): m for m in linear.fit_linear(folded, REGRESSIONS)}
    names = [*linear.design_of(folded).names, "(intercept)"]
    assert len(found) == len(REGRESSIONS) * 6 and max(m.gradient for m in found.values()) < 1e-9
    for cell in [(1, 1), (2, 3)]:
        train = stage(folded.frame(cell).where("part = 'train'").select("key", "y", "features"))
        own = [*feature_names(folded.pipeline(cell), list(SPEC.nums), list(SPEC.cats)), "(intercept)"]
        for c in REGRESSIONS:
            beta = dict(zip(names, found[c.name, cell].beta))
            rows = evaluate.rebalance(train, c.sampling).select(vector_to_array("features").alias("x"), "y").collect()
            x, y = np.array([[*r["x"], 1.0] for r in rows]), np.array([r["y"] for r in rows])
            b = np.array([beta[n] for n in own])
            w = len(y) / (2 * np.where(y == 1, y.sum(), (1 - y).sum())) if c.params["class_weight"] else np.ones(len(y))
            g = c.params["C"] * x.T @ (w * (1 / (1 + np.exp(-x @ b)) - y)) + np.where(np.array(own) == "(intercept)", 0.0, b)
            assert np.abs(g).max() < 1e-6
            assert all(v == 0.0 for n, v in beta.items() if n not in own)
        fitted = models.fit_model("LogisticRegression", train, {**REGRESSIONS[0].params, "tol": 1e-14})
        b = np.array([dict(zip(names, found[REGRESSIONS[0].name, cell].beta))[n] for n in own[:-1]])
        assert np.abs(b - fitted.coefficients.toArray()).max() < 1e-6


def test_scores_are_those_of_the_encoded_rows(folded):
    fitted = linear.fit_linear(folded, REGRESSIONS[:2])
    scores = linear.score_linear(folded, fitted, ("train", "valid"))
    assert scores.count() == folded.rows.count() * 6 * 2
    names = [*linear.design_of(folded).names, "(intercept)"]
    cell, model = (2, 1), fitted[3]
    assert model.cell == cell
    beta = dict(zip(names, model.beta))
    b = np.array([beta[n] for n in feature_names(folded.pipeline(cell), list(SPEC.nums), list(SPEC.cats))])
    got = {r["key"]: r["p"] for r in scores.where((F.col("model") == model.name) & (F.col("repeat") == 2) & (F.col("fold") == 1)).collect()}
    for r in folded.frame(cell).collect():
        assert got[r["key"]] == pytest.approx(1 / (1 + np.exp(-(r["features"].toArray() @ b + beta["(intercept)"]))), abs=1e-12)


def test_gradient_flag_fails_for_a_constant_model(folded):
    fitted = linear.fit_linear(folded, REGRESSIONS[:1])
    scores = stage(linear.score_linear(folded, fitted, ("train",)))
    assert {r["optimal"] for r in model_queries.at_optimum(folded, fitted, scores).collect()} == {True}
    constant = scores.withColumn("p", F.lit(0.3))
    assert {r["optimal"] for r in model_queries.at_optimum(folded, fitted, constant).collect()} == {False}
    assert not model_queries.beats_majority(scores.withColumn("label", F.lit(0))) and model_queries.beats_majority(scores)


def test_training_rows_of_one_class(spark):
    rows = [(i, float(i), "x", int(i == 0)) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, a double, c string, y int")
    one = foldset.holdout_set(df.where("y = 0"), df, TableSpec("id", ("a",), ("c",)))
    got = evaluate.score_candidates(one, [Candidate("LogisticRegression")]).collect()
    assert [(r["p"], r["label"]) for r in got] == [(0.0, 0)] * 6
    with pytest.raises(ValueError):
        evaluate.score_candidates(one, [Candidate("LogisticRegression", {}, "random_oversample")])


def test_plan_and_jobs_do_not_grow_with_candidates(spark, table):
    def scored(n):
        tried = [Candidate("LogisticRegression", {"C": 1.0 + i}, "none", f"#{i}") for i in range(n)]
        jobs = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
        scores = evaluate.score_candidates(evaluate.fold_frames(table, SPEC, 2, 1), tried + [Candidate("DummyMostFreq")])
        return len(scores._jdf.queryExecution().toString().splitlines()), spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - jobs

    few, many = scored(1), scored(6)
    assert few[0] == many[0] and many[1] <= few[1] + 8
