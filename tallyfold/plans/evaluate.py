"""Cross-validation, tuning and refitting on folds.

Preprocessing is refitted for every fold, all folds at once; rows are staged once and encoded when they are read. Logistic
regressions of all candidates and folds are fitted together, other models as Spark jobs from a small pool. Scores go to one path,
from which a single grouped aggregation gives the metrics of all models and folds: its plan does not grow with them.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import partial

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.confusion import DEFAULT_COSTS, LABEL_METRICS, objective_metric
from tallyfold.operators import split
from tallyfold.operators.clean import best_row
from tallyfold.operators.curves import ranking_metrics
from tallyfold.operators.features import preprocessing
from tallyfold.operators.metrics import binary_metrics
from tallyfold.operators.resample import STRATEGIES, Resampler
from tallyfold.plans.foldset import FoldSet, TableSpec, fold_set
from tallyfold.plans.linear import batchable, fit_linear, score_linear
from tallyfold.plans.models import fit_model, score_rows
from tallyfold.runtime import run_jobs, stage, stage_parts


@dataclass(frozen=True)
class Candidate:
    """A named model with parameters and a sampling strategy."""

    model: str
    params: dict = field(default_factory=dict)
    sampling: str = "none"
    label: str | None = None

    @property
    def name(self) -> str:
        return self.label or self.model


def encode(train: DataFrame, apply_to: DataFrame, spec: TableSpec) -> tuple[DataFrame, object]:
    """Fit preprocessing on ``train``; returns (staged encoded ``apply_to``, fitted pipeline)."""
    fitted = preprocessing(list(spec.nums), list(spec.cats), spec.scaler).fit(train)
    extra = [c for c in ("part", "repeat", "fold", "subset") if c in apply_to.columns]
    encoded = fitted.transform(apply_to).select(
        F.col(spec.key).alias("key"), F.col(spec.y).cast("int").alias("y"), "features", *extra
    )
    return stage(encoded, "encoded"), fitted


def resampler(train: DataFrame, strategies: Iterable[str], seed: int = 42) -> Resampler:
    """Strategies on encoded training rows; vectors go through arrays, as interpolation needs."""
    return Resampler(stage(train.select("key", "y", vector_to_array("features").alias("vec")), "to_resample"), strategies, seed)


def rebalance(train: DataFrame, strategy: str, seed: int = 42, planned: Resampler | None = None) -> DataFrame:
    """Resample encoded training rows, by ``planned`` if several strategies share them."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown sampling strategy {strategy!r}")
    if strategy == "none":
        return train
    out = (planned or resampler(train, (strategy,), seed)).rows(strategy)
    return stage(out.select("key", "y", array_to_vector("vec").alias("features")), "balanced")


def fit_candidate(train: DataFrame, c: Candidate, seed: int = 42, planned: Resampler | None = None):
    return fit_model(c.model, rebalance(train, c.sampling, seed, planned), c.params, seed)


def fold_frames(df: DataFrame, spec: TableSpec, k: int, repeats: int, seed: int = 42) -> FoldSet:
    """One encoded frame per (repeat, fold) with ``part`` = 'train' or 'valid'."""
    return fold_set(df, spec, k, repeats, seed)


def score_candidates(
    folds: FoldSet, candidates: list[Candidate], parts: tuple[str, ...] = ("valid",), seed: int = 42
) -> DataFrame:
    """Score frame (key, model, sampling, repeat, fold, part, y, p, label) of every candidate and fold. Staged."""
    together = [c for c in candidates if batchable(folds, c)]
    alone = [c for c in candidates if c not in together]

    frames = list(folds) if alone else []
    trains = [frame.where("part = 'train'").select("key", "y", "features") for frame in frames]
    # What the strategies share is made once per fold.
    samplings = {c.sampling for c in alone} - {"none"}
    planned = run_jobs([partial(resampler, t, samplings, seed) for t in trains]) if samplings else [None] * len(frames)

    def one(i: int, c: Candidate) -> DataFrame:
        frame = frames[i]
        model = fit_candidate(trains[i], c, seed, planned[i])
        rows = frame.where(F.col("part").isin(*parts))
        scored = score_rows(model, rows, by=["part"]).select("key", "repeat", "fold", "part", "y", "p", "label")
        return scored.withColumns({"model": F.lit(c.name), "sampling": F.lit(c.sampling)})

    tasks = [partial(one, i, c) for c in alone for i in range(len(frames))]
    if together:
        tasks.insert(0, lambda: score_linear(folds, fit_linear(folds, together, seed), parts))
    return stage_parts(tasks, "scores", folds.rows.sparkSession)


def cross_validate(
    df: DataFrame, spec: TableSpec, candidates: list[Candidate], k: int = 5, repeats: int = 1, seed: int = 42
) -> DataFrame:
    """(model, repeat, fold, train_acc, val_acc)."""
    scores = score_candidates(fold_frames(df, spec, k, repeats, seed), candidates, ("train", "valid"), seed)
    hit = (F.col("y") == F.col("label")).cast("double")
    return scores.groupBy("model", "repeat", "fold").agg(
        F.avg(F.when(F.col("part") == "train", hit)).alias("train_acc"),
        F.avg(F.when(F.col("part") == "valid", hit)).alias("val_acc"),
    )


def cv_results(
    df: DataFrame, spec: TableSpec, candidates: list[Candidate], k: int = 3, repeats: int = 1, seed: int = 42,
    costs=DEFAULT_COSTS,
) -> DataFrame:
    """Every metric per (model, repeat, fold) on validation rows."""
    scores = score_candidates(fold_frames(df, spec, k, repeats, seed), candidates, seed=seed)
    by = ["model", "sampling", "repeat", "fold"]
    table = binary_metrics(scores, by, costs).join(ranking_metrics(scores, by), by)
    return table.select(
        "model", "repeat", "fold", F.lit(k).alias("n_splits"), F.lit(repeats).alias("n_repeats_cv"),
        F.col("sampling").alias("sampling_strategy"), *LABEL_METRICS, "roc_auc", "pr_auc",
    )


# Search ranges per model. Kinds: int, float, log (log-uniform), choice.
SEARCH_SPACE: dict[str, dict[str, tuple]] = {
    "DummyMostFreq": {},
    "LogisticRegression": {
        "C": ("log", 1e-3, 1e3),
        "class_weight": ("choice", [None, "balanced"]),
        "solver": ("choice", ["lbfgs"]),
    },
    "RandomForest": {
        "n_estimators": ("int", 100, 400),
        "max_depth": ("int", 3, 100),
        "min_samples_split": ("int", 2, 50),
        "min_samples_leaf": ("int", 1, 10),
        "max_features": ("choice", ["sqrt", "log2", 0.5]),
        "class_weight": ("choice", [None, "balanced", "balanced_subsample"]),
        "criterion": ("choice", ["gini", "entropy", "log_loss"]),
    },
    "GradientBoosting": {
        "n_estimators": ("int", 50, 500),
        "learning_rate": ("log", 1e-3, 5e-1),
        "max_depth": ("int", 2, 100),
        "subsample": ("float", 0.25, 1.0),
        "min_samples_leaf": ("int", 1, 50),
        "min_weight_fraction_leaf": ("float", 0.0, 0.5),
        "min_impurity_decrease": ("float", 0.0, 0.5),
        "max_features": ("choice", ["sqrt", "log2", 0.5]),
        "min_samples_split": ("int", 2, 50),
    },
    "LightGBM": {
        "n_estimators": ("int", 50, 500),
        "learning_rate": ("log", 1e-3, 5e-1),
        "max_depth": ("int", 3, 100),
        "num_leaves": ("int", 10, 200),
        "subsample": ("float", 0.5, 1.0),
        "colsample_bytree": ("float", 0.5, 1.0),
        "reg_alpha": ("log", 1e-8, 10.0),
        "reg_lambda": ("log", 1e-8, 10.0),
        "min_child_samples": ("int", 5, 100),
        "min_split_gain": ("float", 0.0, 1.0),
        "class_weight": ("choice", [None, "balanced"]),
    },
    "SVC": {
        "C": ("log", 1e-2, 1e2),
        "gamma": ("choice", ["scale", "auto"]),
        "class_weight": ("choice", [None, "balanced"]),
        "tol": ("log", 1e-4, 1e-1),
        "max_iter": ("int", 1000, 10000),
    },
    "MLPClassifier": {
        "solver": ("choice", ["adam"]),
        "hidden_layer_sizes": ("choice", ["64", "64-32"]),
        "activation": ("choice", ["relu", "tanh", "logistic"]),
        "alpha": ("log", 1e-5, 1e-2),
        "max_iter": ("int", 100, 1000),
        "tol": ("log", 1e-5, 1e-2),
        "learning_rate_init": ("log", 1e-4, 1e-2),
        "beta_1": ("float", 0.90, 0.99),
        "beta_2": ("float", 0.99, 0.9999),
    },
}
# Ranges that apply only under a chosen solver.
SOLVER_SPACE = {
    ("LogisticRegression", "liblinear"): {"penalty": ("choice", ["l2", "l1"])},
    ("LogisticRegression", "saga"): {"l1_ratio": ("float", 0.0, 1.0)},
}


def _draw(rng: random.Random, rule: tuple):
    kind, *bounds = rule
    if kind == "choice":
        return rng.choice(bounds[0])
    if kind == "int":
        return rng.randint(*bounds)
    if kind == "float":
        return rng.uniform(*bounds)
    return math.exp(rng.uniform(math.log(bounds[0]), math.log(bounds[1])))


def suggest(model: str, trial: int, samplings: tuple[str, ...] = ("none",), seed: int = 42, space=None) -> Candidate:
    """Seeded random draw; the sampling strategy is one of the dimensions."""
    if model not in SEARCH_SPACE:
        raise ValueError(f"no search space for {model!r}")
    rng = random.Random(f"{seed}|{model}|{trial}")
    sampling = "none" if model == "DummyMostFreq" else rng.choice(list(samplings))
    params = {name: _draw(rng, rule) for name, rule in (space or SEARCH_SPACE)[model].items()}
    for name, rule in SOLVER_SPACE.get((model, params.get("solver")), {}).items():
        params[name] = _draw(rng, rule)
    if "l1_ratio" in params:
        params["penalty"] = "elasticnet"
    return Candidate(model, params, sampling, f"{model}#{trial}")


def grid(model: str, choices: dict[str, list], samplings: tuple[str, ...] = ("none",)) -> list[Candidate]:
    """Every combination of the given values, for a grid search."""
    combos: list[dict] = [{}]
    for name, values in choices.items():
        combos = [{**c, name: v} for c in combos for v in values]
    drawn = [(c, s) for c in combos for s in samplings]
    return [Candidate(model, c, s, f"{model}#{i}") for i, (c, s) in enumerate(drawn)]


def trial_table(spark: SparkSession, candidates: list[Candidate]) -> DataFrame:
    """(model, trial, sampling_strategy, params): the trials as a table."""
    rows = [
        (c.model, int(c.name.rsplit("#", 1)[1]), c.name, c.sampling, {k: str(v) for k, v in c.params.items()})
        for c in candidates
    ]
    schema = "model string, trial int, name string, sampling_strategy string, params map<string,string>"
    return spark.createDataFrame(rows, schema)


def tuning_study(
    df: DataFrame, spec: TableSpec, candidates: list[Candidate], objective: str = "mcc", k: int = 3, repeats: int = 1,
    seed: int = 42, costs=DEFAULT_COSTS,
) -> DataFrame:
    """One row per trial: model, trial, mean objective over the folds, parameters."""
    metric = objective_metric(objective)
    scores = score_candidates(fold_frames(df, spec, k, repeats, seed), candidates, seed=seed)
    folds = binary_metrics(scores, ["model", "repeat", "fold"], costs, (metric,))
    means = folds.groupBy(F.col("model").alias("name")).agg(F.avg(metric).alias("objective"))
    return (
        trial_table(df.sparkSession, candidates).join(means, "name", "left").drop("name")
        .withColumns({"n_splits": F.lit(k), "n_repeats_tuning": F.lit(repeats)})
    )


def best_params(trials: DataFrame) -> DataFrame:
    """The best trial per model, the earliest on ties."""
    return best_row(trials, "objective", "trial", ["model"])


def select_and_refit(df: DataFrame, spec: TableSpec, comparison: DataFrame, candidates: list[Candidate], objective: str):
    """Refit the candidate with the best mean objective on all training rows: (candidate, pipeline, model)."""
    best = comparison.orderBy(F.desc(f"mean_{objective}"), "model").first()["model"]
    chosen = next(c for c in candidates if c.name == best)
    encoded, fitted = encode(df, df, spec)
    return chosen, fitted, fit_candidate(encoded, chosen)


def score_table(fitted, model, df: DataFrame, spec: TableSpec, fallback: str = "rank") -> DataFrame:
    """(key, y, p, label) of new rows through a fitted pipeline and model."""
    rows = fitted.transform(df).select(F.col(spec.key).alias("key"), F.col(spec.y).cast("int").alias("y"), "features")
    return score_rows(model, rows, fallback).drop("features")


def learning_curve(
    df: DataFrame, spec: TableSpec, candidate: Candidate, sizes: list[float], k: int = 3, objective: str = "mcc",
    seed: int = 42,
) -> DataFrame:
    """(size, n_train, fold, train, val): the objective on growing, nested training subsets."""
    metric = objective_metric(objective)
    frames = fold_frames(df, spec, k, 1, seed)

    def one(frame: DataFrame, i: int, ranked: DataFrame) -> DataFrame:
        used = ranked.where(F.col("subset").between(1, i + 1))
        model = fit_candidate(used.select("key", "y", "features"), candidate, seed)
        rows = used.drop("subset").unionByName(frame.where("part = 'valid'"))
        scored = score_rows(model, rows, by=["part"]).select("fold", "part", "y", "p", "label")
        return scored.withColumn("size", F.lit(sizes[i]))

    subsets = run_jobs(
        [partial(lambda f: stage(split.nested_subsets(f.where("part = 'train'"), ["key"], sizes, seed), "subsets"), f) for f in frames]
    )
    tasks = [partial(one, f, i, s) for f, s in zip(frames, subsets) for i in range(len(sizes))]
    scores = stage_parts(tasks, "curve", df.sparkSession)
    cells = binary_metrics(scores, ["size", "fold", "part"], only=(metric,))
    value = F.col(metric)
    rows = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    return cells.groupBy("size", "fold").agg(
        F.max(F.when(F.col("part") == "train", rows)).alias("n_train"),
        F.max(F.when(F.col("part") == "train", value)).alias("train"),
        F.max(F.when(F.col("part") == "valid", value)).alias("val"),
    )
