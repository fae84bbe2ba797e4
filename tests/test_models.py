"""Registry, search spaces, fitted models and their evaluation."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tallyfold.operators.diagnose import ensemble_decision, fit_verdict
from tallyfold.operators.metrics import binary_metrics
from tallyfold.plans import evaluate, models
from tallyfold.plans.evaluate import Candidate, TableSpec
from tallyfold.plans.model_queries import quality_test_metrics

SPEC = TableSpec("id", ("a", "b"), ("c",))


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(400).select(
        "id", F.randn(1).alias("a"), F.when(F.rand(9) < 0.9, F.randn(2)).alias("b"),
        F.when(F.col("id") % 3 == 0, "u").otherwise("v").alias("c"),
    )
    y = (F.col("a") * 2 + F.coalesce("b", F.lit(0.0)) + F.randn(3) * 0.3 > 0.8).cast("int")
    return df.withColumn("y", y).persist()


def test_registry():
    assert models.model_params("RandomForest", {"n_estimators": 7})["n_estimators"] == 7
    assert models.create_estimator("RandomForest", {"n_estimators": 7}).getNumTrees() == 7
    assert models.create_estimator("RandomForest").getMaxDepth() == 30
    assert models.model_params("MLPClassifier", {"hidden_layer_sizes": "64-32"})["hidden_layer_sizes"] == (64, 32)
    with pytest.raises(ValueError):
        models.create_estimator("Oracle")
    with pytest.raises(ValueError):
        evaluate.suggest("Oracle", 0)


def test_suggestions_are_seeded_and_in_range():
    a, b = evaluate.suggest("LightGBM", 3, ("none", "smote")), evaluate.suggest("LightGBM", 3, ("none", "smote"))
    assert a == b and a.sampling in ("none", "smote")
    assert 50 <= a.params["n_estimators"] <= 500 and 1e-3 <= a.params["learning_rate"] <= 0.5
    space = {"LogisticRegression": {"solver": ("choice", ["saga"])}}
    assert evaluate.suggest("LogisticRegression", 0, space=space).params["penalty"] == "elasticnet"


@pytest.mark.parametrize("name,params", [
    ("LogisticRegression", {"max_iter": 50}), ("RandomForest", {"n_estimators": 5, "max_depth": 4}),
    ("GradientBoosting", {"n_estimators": 3}), ("LightGBM", {"n_estimators": 3}), ("SVC", {"max_iter": 20}),
    ("MLPClassifier", {"hidden_layer_sizes": "4", "max_iter": 60}),
])
def test_models_learn_and_score_in_range(table, name, params):
    encoded, _ = evaluate.encode(table, table, SPEC)
    scores = models.score_rows(models.fit_model(name, encoded, params), encoded)
    row = scores.agg(F.min("p"), F.max("p"), F.avg((F.col("y") == F.col("label")).cast("double"))).first()
    assert 0 <= row[0] <= row[1] <= 1 and row[2] > 0.8


def test_majority_baseline(table):
    scores = models.score_rows(models.fit_model("DummyMostFreq", table), table.select("id", "y"))
    row = binary_metrics(scores).first()
    share = table.agg(F.avg((F.col("y") == 0).cast("double"))).first()[0]
    assert row["mcc"] == 0 and row["accuracy"] == pytest.approx(max(share, 1 - share))


def test_logistic_matches_penalised_optimum(table):
    """The gradient of C * sum(w * loss) + |beta|^2 / 2 vanishes at the fitted coefficients."""
    import numpy as np

    encoded, _ = evaluate.encode(table, table, SPEC)
    model = models.fit_model("LogisticRegression", encoded, {"C": 2.0, "class_weight": None, "tol": 1e-10, "max_iter": 500})
    rows = encoded.select(vector_to_array("features").alias("x"), "y").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])
    beta = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ beta + model.intercept)))
    assert np.abs(2.0 * x.T @ (p - y) + beta).max() < 1e-2


def test_preprocessing_is_fitted_on_training_rows(table):
    frames = evaluate.fold_frames(table, SPEC, 2, 1)
    assert len(frames) == 2
    for frame in frames:
        assert frame.count() == 400
        medians = frame.select("part", vector_to_array("features")[0].alias("v")).groupBy("part").agg(F.median("v").alias("m"))
        got = {r["part"]: r["m"] for r in medians.collect()}
        assert got["train"] == pytest.approx(0.0, abs=1e-9) and got["valid"] != 0.0


def test_cross_validation_beats_baseline(table):
    tried = [Candidate("DummyMostFreq"), Candidate("LogisticRegression", {"max_iter": 50})]
    means = {r["model"]: r["v"] for r in evaluate.cross_validate(table, SPEC, tried, 2).groupBy("model").agg(
        F.avg("val_acc").alias("v")).collect()}
    assert means["LogisticRegression"] > means["DummyMostFreq"]


def test_unknown_objective_raises(table):
    with pytest.raises(ValueError):
        evaluate.tuning_study(table, SPEC, [Candidate("DummyMostFreq", label="DummyMostFreq#0")], "profit")


def test_verdicts(spark):
    df = spark.createDataFrame([(0.9, 0.7), (0.4, 0.35), (0.8, 0.75)], "t double, v double")
    assert [r[0] for r in df.select(fit_verdict("t", "v")).collect()] == ["overfit", "underfit", "well-fitted"]
    single = spark.createDataFrame([("lr", 0.5)], "model string, mcc double")
    same = spark.createDataFrame([(0.5,)], "mcc double")
    assert ensemble_decision(single, same).first()["keep"] == "lr"


def test_flagship_query(spark):
    row = quality_test_metrics(spark, "/root/testdata/sf0.001").first()
    assert 0 <= row["accuracy"] <= 1 and row["roc_auc"] is not None


def test_fourier_features_are_made_by_slices(spark, monkeypatch):
    """A batch is projected some rows at a time into one buffer; what comes out does not depend on the slices."""
    monkeypatch.setattr(models, "PROJECTED_ROWS", 7)
    rng = np.random.default_rng(4)
    x, weights, phases = rng.normal(size=(50, 3)), rng.normal(size=(3, 5)), rng.uniform(size=5)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i int, x array<double>")
    frame = df.repartition(2).select("i", array_to_vector("x").alias("features"))
    made = models.FourierModel(weights, phases).project(frame)
    for r in made.collect():
        assert np.allclose(r["fourier"].toArray(), np.sqrt(2 / 5) * np.cos(x[r["i"]] @ weights + phases), rtol=0, atol=1e-14)
    assert made.where("i < 0").count() == 0
