"""Named classifiers on Spark ML, one fitting entry point and the score frame they produce.

Model and parameter names follow the usual Python ones, so existing configurations carry over.
Substitutes, and what they do not honour:

* ``LightGBM``      level-wise boosted trees; depth is taken from the leaf count, L1/L2 leaf
                    penalties and column sampling per tree are ignored
* ``SVC``           random Fourier features and a linear SVM: an approximate RBF kernel, no
                    probability, so scores come from the margin
* ``MLPClassifier`` sigmoid hidden layers trained by L-BFGS; activation, alpha and Adam settings
                    are ignored
* trees             depth is at most 30; ``min_samples_split`` is ignored; the log-loss criterion
                    is the entropy one; ``balanced_subsample`` weights count as ``balanced``
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.scalars import sigmoid
from tallyfold.operators.features import with_class_weight
from tallyfold.operators.order import average_rank

MAX_DEPTH = 30  # the deepest tree Spark ML grows
FOURIER_FEATURES = 256
PROJECTED_ROWS = 512  # rows projected at a time

# Default parameters per model.
DEFAULTS: dict[str, dict] = {
    "DummyMostFreq": {},
    "LogisticRegression": {"C": 15.0, "penalty": "l2", "class_weight": "balanced", "max_iter": 10000, "tol": 1e-5},
    "RandomForest": {
        "n_estimators": 200, "max_depth": None, "min_samples_leaf": 1, "max_features": "sqrt", "criterion": "gini",
        "class_weight": None,
    },
    "GradientBoosting": {
        "n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "subsample": 1.0, "min_samples_leaf": 1,
        "min_weight_fraction_leaf": 0.0, "min_impurity_decrease": 0.0, "max_features": None,
    },
    "LightGBM": {
        "n_estimators": 100, "learning_rate": 0.1, "max_depth": -1, "num_leaves": 31, "subsample": 1.0,
        "min_child_samples": 20, "min_split_gain": 0.0, "class_weight": None,
    },
    "SVC": {"C": 1.0, "gamma": "scale", "class_weight": None, "max_iter": 1000, "tol": 1e-3},
    "MLPClassifier": {"hidden_layer_sizes": (100,), "max_iter": 200, "tol": 1e-4},
}
HONOURED_TOO = {"l1_ratio"}
IGNORED = {
    "sampling_strategy", "solver", "l1_ratio", "min_samples_split", "colsample_bytree", "reg_alpha", "reg_lambda",
    "activation", "alpha", "learning_rate_init", "beta_1", "beta_2", "random_state", "n_jobs",
}


_warned: set[tuple[str, str]] = set()


@dataclass(frozen=True)
class TrainingFacts:
    """What some estimators need to know about the training rows."""

    weight_sum: float
    n_features: int
    variance: float = 1.0


def model_params(name: str, params: dict | None = None) -> dict:
    """Defaults overlaid with ``params``; layer sizes may come as text such as ``64-32``.

    A parameter that no model here knows raises; one that is known but not honoured is named in a warning, once.
    """
    if name not in DEFAULTS:
        raise ValueError(f"unknown model {name!r}; choose one of {sorted(DEFAULTS)}")
    given = set(params or {}) - set(DEFAULTS[name]) - (HONOURED_TOO if name == "LogisticRegression" else set())
    if unknown := sorted(given - IGNORED):
        raise ValueError(f"unknown parameters of {name}: {unknown}")
    for extra in sorted(given):
        if (name, extra) not in _warned:
            _warned.add((name, extra))
            warnings.warn(f"{name}: {extra} is ignored", stacklevel=2)
    fraction = float((params or {}).get("min_weight_fraction_leaf", 0.0))
    if not 0.0 <= fraction < 0.5:
        raise ValueError("min_weight_fraction_leaf must be at least 0 and below 0.5")
    merged = {**DEFAULTS[name], **(params or {})}
    layers = merged.get("hidden_layer_sizes")
    if isinstance(layers, str):
        merged["hidden_layer_sizes"] = tuple(int(part) for part in layers.split("-"))
    return merged


def _depth(value) -> int:
    return MAX_DEPTH if value is None or int(value) < 0 else min(int(value), MAX_DEPTH)


def _subset(value) -> str:
    return "all" if value is None else str(value)


def create_estimator(name: str, params: dict | None = None, facts: TrainingFacts | None = None, seed: int = 42):
    """An unfitted Spark ML stage on ``features``/``y``, with ``weight`` where the learner takes one."""
    p = model_params(name, params)
    facts = facts or TrainingFacts(1.0, 1)
    cols = {"featuresCol": "features", "labelCol": "y"}
    if name == "DummyMostFreq":
        return None
    if name == "LogisticRegression":
        ratio = {"l1": 1.0, "l2": 0.0}.get(p["penalty"], p.get("l1_ratio", 0.5))
        return LogisticRegression(
            **cols, weightCol="weight", standardization=False, regParam=1.0 / (float(p["C"]) * facts.weight_sum),
            elasticNetParam=float(ratio), maxIter=int(p["max_iter"]), tol=float(p["tol"]), family="binomial",
        )
    if name == "RandomForest":
        return RandomForestClassifier(
            **cols, weightCol="weight", numTrees=int(p["n_estimators"]), maxDepth=_depth(p["max_depth"]),
            minInstancesPerNode=int(p["min_samples_leaf"]), featureSubsetStrategy=_subset(p["max_features"]),
            impurity="gini" if p["criterion"] == "gini" else "entropy", seed=seed,
        )
    if name == "GradientBoosting":
        return GBTClassifier(
            **cols, weightCol="weight", maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]),
            maxDepth=_depth(p["max_depth"]), subsamplingRate=float(p["subsample"]),
            minInstancesPerNode=int(p["min_samples_leaf"]),
            minWeightFractionPerNode=float(p["min_weight_fraction_leaf"]),
            minInfoGain=float(p["min_impurity_decrease"]), featureSubsetStrategy=_subset(p["max_features"]), seed=seed,
        )
    if name == "LightGBM":
        by_leaves = math.ceil(math.log2(int(p["num_leaves"])))
        return GBTClassifier(
            **cols, weightCol="weight", maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]),
            maxDepth=min(_depth(p["max_depth"]), by_leaves), subsamplingRate=float(p["subsample"]),
            minInstancesPerNode=int(p["min_child_samples"]), minInfoGain=float(p["min_split_gain"]), seed=seed,
        )
    if name == "SVC":
        return LinearSVC(
            featuresCol="fourier", labelCol="y", weightCol="weight", standardization=False,
            regParam=1.0 / (float(p["C"]) * facts.weight_sum), maxIter=int(p["max_iter"]), tol=float(p["tol"]),
        )
    layers = [facts.n_features, *map(int, p["hidden_layer_sizes"]), 2]
    return MultilayerPerceptronClassifier(**cols, layers=layers, maxIter=int(p["max_iter"]), tol=float(p["tol"]), seed=seed)


class MajorityModel(Model):
    """Always the most frequent training class, with probability one."""

    def __init__(self, label: int = 0):
        super().__init__()
        self.label = label

    def _transform(self, dataset: DataFrame) -> DataFrame:
        one_hot = F.array(*[F.lit(1.0 if i == self.label else 0.0) for i in (0, 1)])
        return dataset.withColumn("prediction", F.lit(float(self.label))).withColumn("probability", array_to_vector(one_hot))


class FourierModel(Model):
    """Random Fourier features, then a linear model on them."""

    def __init__(self, weights: np.ndarray, phases: np.ndarray, linear=None):
        super().__init__()
        self.weights, self.phases, self.linear = weights, phases, linear

    def project(self, dataset: DataFrame) -> DataFrame:
        weights, phases = self.weights, self.phases
        scale, step = math.sqrt(2.0 / len(phases)), PROJECTED_ROWS

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def fourier(x: pa.Array) -> pa.Array:
            # One buffer for a batch, filled by slices: an array per row would take several times as much.
            rows, width = len(x), len(phases)
            given = x.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1) if rows else np.zeros((0, len(weights)))
            out = np.empty((rows, width))
            for lo in range(0, rows, step):
                out[lo : lo + step] = scale * np.cos(given[lo : lo + step] @ weights + phases)
            return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(out.ravel()))

        return dataset.withColumn("fourier", array_to_vector(fourier(vector_to_array("features"))))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.linear.transform(self.project(dataset)).drop("fourier")


def training_facts(train: DataFrame, need_variance: bool = False) -> TrainingFacts:
    measures = [F.sum("weight").alias("w"), F.first(F.size(vector_to_array("features"))).alias("d")]
    if need_variance:
        measures += [
            Summarizer.mean(F.col("features")).alias("mean"),
            Summarizer.normL2(F.col("features")).alias("l2"),
            F.count("*").alias("n"),
        ]
    row = train.agg(*measures).first()
    variance = 1.0
    if need_variance:  # variance over every cell of the matrix
        mean = float(np.mean(row["mean"].toArray()))
        square = float(np.sum(row["l2"].toArray() ** 2)) / (row["n"] * row["d"])
        variance = max(square - mean * mean, 1e-12)
    return TrainingFacts(float(row["w"]), int(row["d"]), variance)


def fit_model(name: str, train: DataFrame, params: dict | None = None, seed: int = 42) -> Model:
    """Fit a named classifier on rows with ``features`` and ``y``."""
    p = model_params(name, params)
    if name == "DummyMostFreq":
        top = train.groupBy("y").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "y").first()
        return MajorityModel(int(top["y"]))
    if p.get("class_weight") in ("balanced", "balanced_subsample"):
        weighted = with_class_weight(train)
    else:
        weighted = train.withColumn("weight", F.lit(1.0))
    if name in ("RandomForest", "GradientBoosting", "LightGBM"):
        return create_estimator(name, params, seed=seed).fit(weighted)
    facts = training_facts(weighted, name == "SVC")
    if name != "SVC":
        return create_estimator(name, params, facts, seed).fit(weighted)
    gamma = 1.0 / facts.n_features / (facts.variance if p["gamma"] == "scale" else 1.0)
    gamma = float(p["gamma"]) if not isinstance(p["gamma"], str) else gamma
    rng = np.random.default_rng(seed)
    weights = rng.normal(0.0, math.sqrt(2.0 * gamma), (facts.n_features, FOURIER_FEATURES))
    model = FourierModel(weights, rng.uniform(0.0, 2.0 * math.pi, FOURIER_FEATURES))
    model.linear = create_estimator(name, params, facts, seed).fit(model.project(weighted))
    return model


def score_rows(model: Model, df: DataFrame, fallback: str = "rank", by: list[str] | None = None) -> DataFrame:
    """Add ``p`` and ``label``.

    Without a probability, ``p`` is the rank-scaled margin ("rank") or its sigmoid ("sigmoid");
    without a margin it is the predicted label.
    """
    out = model.transform(df)
    label = F.col("prediction").cast("int").alias("label")
    keep = df.columns
    if "probability" in out.columns:
        return out.select(*keep, vector_to_array("probability")[1].alias("p"), label)
    if "rawPrediction" not in out.columns:
        return out.select(*keep, F.col("prediction").cast("double").alias("p"), label)
    margin = out.select(*keep, vector_to_array("rawPrediction")[1].alias("margin"), label)
    if fallback == "sigmoid":
        return margin.withColumn("p", sigmoid("margin")).select(*keep, "p", "label")
    return average_rank(margin, "margin", by, "p").select(*keep, "p", "label")


def importance_table(model: Model, names: list[str], spark, top: int = 20) -> DataFrame:
    """(feature, importance), largest first; models without importances raise."""
    if not hasattr(model, "featureImportances"):
        raise ValueError(f"{type(model).__name__} has no feature importances")
    values = model.featureImportances.toArray().tolist()  # one number per feature slot
    rows = spark.createDataFrame(list(zip(names, values)), "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature").limit(top)
