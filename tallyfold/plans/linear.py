"""Logistic regressions of many candidates and folds, fitted and scored together.

A row is brought into one form that serves all folds: scaled numbers, marks of missing ones, one slot per category. What a fold's
imputing and scaling make of it is linear in that form, so the margins of all models are one product of matrices, and so are the
gradients. A scan of the rows sums gradients and Hessians of every model; the driver takes a damped Newton step for each of them,
and those that have arrived drop out. Work per scan grows with the models, the number of jobs does not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyfold.functions.scalars import hash_key, hash_uniform
from tallyfold.operators.features import feature_names
from tallyfold.operators.folds import Cell, complement_hash_cuts
from tallyfold.plans.foldset import FoldSet
from tallyfold.plans.models import model_params
from tallyfold.runtime import local_frame, lookup_join, stage_parts

MAX_WIDTH = 512  # wider designs are fitted one by one
HESSIAN_CELLS = 1 << 23  # numbers of all Hessians that one task holds; more models are fitted in turns
BUCKETS = 16  # beyond four times as many tasks, their sums are added up in so many groups before they come to the driver
ROWS = 4096
SAMPLINGS = ("none", "random_undersample", "random_oversample")  # those that only decide how often a row counts
STEP = 1e-10  # a model has arrived when no coefficient moves by more than this part of the largest


@dataclass
class Design:
    """How a row becomes the common form, and per cell the matrix that turns coefficients on encoded features into ones on it."""

    nums: list[str]
    cats: list[str]
    centre: np.ndarray
    scale: np.ndarray
    slots: list[list[str]]
    maps: dict[Cell, np.ndarray]  # (common form) x (encoded features and intercept)
    names: list[str]

    @property
    def width(self) -> int:
        return 2 * len(self.nums) + sum(map(len, self.slots)) + len(self.cats) + 1

    def rows(self, batch: pa.RecordBatch) -> np.ndarray:
        """Rows as [numbers (0 if missing), marks of missing numbers, slots, marks of missing strings, 1]."""
        n = batch.num_rows
        z = np.zeros((n, self.width))
        p, at = len(self.nums), 2 * len(self.nums)
        for j, name in enumerate(self.nums):
            v = batch.column(batch.schema.names.index(name)).cast(pa.float64()).to_numpy(zero_copy_only=False)
            gone = np.isnan(v)
            z[:, j] = np.where(gone, 0.0, (v - self.centre[j]) / self.scale[j])
            z[:, p + j] = gone
        marks = at + sum(map(len, self.slots))
        for j, (name, values) in enumerate(zip(self.cats, self.slots)):
            column = batch.column(batch.schema.names.index(name)).cast(pa.string())
            code = pc.index_in(column, value_set=pa.array(values, pa.string())).to_numpy(zero_copy_only=False)
            known = ~np.isnan(code.astype(np.float64))
            z[np.flatnonzero(known), at + code[known].astype(np.int64)] = 1.0
            z[:, marks + j] = column.is_null().to_numpy(zero_copy_only=False)
            at += len(values)
        z[:, -1] = 1.0
        return z


def design_of(folds: FoldSet) -> Design:
    spec = folds.spec
    nums, cats = list(spec.nums), list(spec.cats)
    first = [next((folds.numbers[c][n] for c in folds.cells if n in folds.numbers[c]), (0.0, [0.0, 0.0, 1.0])) for n in nums]
    centre = np.array([quart[1] for _, quart in first])
    scale = np.array([(quart[2] - quart[0]) or 1.0 for _, quart in first])
    slots = [sorted({v for c in folds.cells for v in folds.categories[c].get(name, ("", []))[1]}) for name in cats]
    p, k = len(nums), sum(map(len, slots))
    maps = {}
    for cell in folds.cells:
        m = np.zeros((2 * p + k + len(cats) + 1, p + k + 1))
        for j, name in enumerate(nums):
            median, (low, mid, high) = folds.numbers[cell].get(name, (0.0, [0.0, 0.0, 0.0]))
            low, mid, high = (low, mid, high) if spec.scaler == "robust" else (0.0, 0.0, 1.0)
            spread = (high - low) or 1.0
            m[j, j] = scale[j] / spread
            m[p + j, j] = (median - centre[j]) / spread
            m[-1, j] = (centre[j] - mid) / spread
        at = 0
        for j, name in enumerate(cats):
            mode, seen = folds.categories[cell].get(name, ("", []))
            for i, value in enumerate(slots[j]):
                if value in seen:  # a category the training rows do not have encodes to zeros
                    m[2 * p + at + i, p + at + i] = 1.0
            if mode in slots[j]:
                m[2 * p + k + j, p + at + slots[j].index(mode)] = 1.0
            at += len(slots[j])
        m[-1, -1] = 1.0
        maps[cell] = m
    names = [*nums, *[f"{c}_{v}" for c, values in zip(cats, slots) for v in values]]
    return Design(nums, cats, centre, scale, slots, maps, names)


@dataclass
class LinearModel:
    """One fitted regression: coefficients on encoded features, the intercept last."""

    name: str
    sampling: str
    cell: Cell
    c: float
    weights: tuple[float, float]  # of the classes 0 and 1
    beta: np.ndarray
    rule: tuple | None = None  # what resampling makes of a row: ("keep", class, cut) or ("copy", class, copies of each, cut)
    loss: float = np.inf
    gradient: float = np.inf  # largest part of the gradient, as a share of what its terms add up to
    steps: int = 0


def batchable(folds: FoldSet, candidate) -> bool:
    """Whether a candidate is a logistic regression with the smooth penalty on rows as they are, or on some of them or copies."""
    if candidate.model != "LogisticRegression" or candidate.sampling not in SAMPLINGS or folds.spec.scaler not in ("robust", "none"):
        return False
    return model_params(candidate.model, candidate.params)["penalty"] == "l2" and design_of(folds).width <= MAX_WIDTH


def _draws(seed: int) -> dict:
    """The hashes by which :mod:`resample` keeps rows of the larger class and gives extra copies to rows of the smaller one."""
    return {name: hash_uniform(hash_key(f"{seed}|{salt}", "key")) for name, salt in (("keep", "keep"), ("copy", "copies"))}


def _rules(folds: FoldSet, counts: list[dict[int, int]], samplings: set[str], seed: int) -> dict[tuple[str, int], tuple]:
    """How often a training row counts, per sampling strategy and cell; the cuts of all cells come from one count."""
    if not samplings:
        return {}
    wanted, plans = [], {}
    for i, n in enumerate(counts):
        if len(n) != 2:
            raise ValueError("rebalancing needs exactly two classes")
        (small, label), (large, other) = sorted((v, y) for y, v in n.items())
        if "random_undersample" in samplings:
            wanted.append((f"keep{other}", i, small - 1, large))
            plans["random_undersample", i] = ("keep", other, None)
        if "random_oversample" in samplings:
            whole, rest = divmod(large - small, small)
            plans["random_oversample", i] = ("copy", label, whole, None if rest else -1.0)
            wanted += [(f"copy{label}", i, rest - 1, small)] if rest else []
    draws = _draws(seed)
    hashes = {f"{name}{y}": F.when(F.col("y") == y, h) for name, h in draws.items() for y in (0, 1)}
    cuts = complement_hash_cuts(folds.rows, {n: h for n, h in hashes.items() if n in {w[0] for w in wanted}}, folds.cells, wanted)
    return {(s, i): (*p[:-1], cuts[f"{p[0]}{p[1]}", i] if p[-1] is None else p[-1]) for (s, i), p in plans.items()}


def _sums(folds: FoldSet, design: Design, models: list[LinearModel], betas: list[np.ndarray], seed: int) -> list[np.ndarray]:
    """Per model: [loss, gradient, size of the gradient's terms, Hessian], flat, over its training rows."""
    cells = [m.cell for m in models]
    gamma = np.stack([design.maps[m.cell] @ b for m, b in zip(models, betas)], axis=1)
    weights = np.array([m.weights for m in models])
    cs = np.array([m.c for m in models])
    rules = [m.rule for m in models]
    d = design.width

    def times(rule: tuple, y: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        kind, label, *copies, cut = rule
        low = batch.column(batch.schema.names.index(kind)).to_numpy(zero_copy_only=False) <= cut
        return np.where(y == label, low if kind == "keep" else 1.0 + copies[0] + low, 1.0)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(cells), 1 + 2 * d + d * d))
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                some = batch.slice(lo, ROWS)
                z = design.rows(some)
                y = some.column(some.schema.names.index("y")).to_numpy(zero_copy_only=False).astype(np.int64)
                f = np.array(some.column(some.schema.names.index("folds")).to_pylist())
                margin = z @ gamma
                for i, (repeat, fold) in enumerate(cells):
                    w = np.where(f[:, repeat - 1] != fold, cs[i] * weights[i][y], 0.0)
                    if rules[i]:
                        w *= times(rules[i], y, some)
                    t = margin[:, i]
                    p = 1.0 / (1.0 + np.exp(-np.clip(t, -700, 700)))
                    miss = w * (p - y)
                    total[i, 0] += float(w @ (np.logaddexp(0.0, t) - y * t))
                    total[i, 1 : 1 + d] += z.T @ miss
                    total[i, 1 + d : 1 + 2 * d] += np.abs(z).T @ np.abs(miss)
                    total[i, 1 + 2 * d :] += ((z * (w * p * (1.0 - p))[:, None]).T @ z).ravel()
        bucket = TaskContext.get().partitionId() % BUCKETS
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([total.tobytes()])], names=["bucket", "sums"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(pdf["sums"].iloc[0]).copy()
        for b in pdf["sums"].iloc[1:]:
            total += np.frombuffer(b)
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "sums": [total.tobytes()]})

    kind = "bucket int, sums binary"
    drawn = _draws(seed) if any(rules) else {}
    rows = folds.rows.select("y", "folds", *[F.col(f"`{c}`") for c in (*design.nums, *design.cats)], *[h.alias(n) for n, h in drawn.items()])
    sums = rows.mapInArrow(scan, kind)  # one row per task
    parts = (sums if rows.rdd.getNumPartitions() <= 4 * BUCKETS else sums.groupBy("bucket").applyInPandas(add, kind)).collect()
    summed = np.sum([np.frombuffer(r["sums"]) for r in sorted(parts)], axis=0).reshape(len(cells), -1)
    return list(summed)


def _look(design: Design, model: LinearModel, beta: np.ndarray, sums: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, float]:
    """(objective, gradient, Hessian, relative size of the gradient) in the coefficients: C * weighted loss + |beta|^2 / 2."""
    d, a = design.width, design.maps[model.cell]
    free = beta.copy()
    free[-1] = 0.0  # the intercept is not penalised
    gradient = a.T @ sums[1 : 1 + d] + free
    terms = np.abs(a).T @ sums[1 + d : 1 + 2 * d] + np.abs(free)
    hessian = a.T @ sums[1 + 2 * d :].reshape(d, d) @ a + np.diag([*np.ones(len(beta) - 1), 0.0])
    relative = float(np.max(np.abs(gradient) / np.maximum(terms, 1e-300)))
    return float(sums[0] + free @ free / 2), gradient, hessian, relative


def fit_linear(folds: FoldSet, candidates: list, seed: int = 42, max_steps: int = 100) -> list[LinearModel]:
    """Every candidate on every cell, at the optimum of C * sum(weight * loss) + |beta|^2 / 2 (intercept free).

    ``class_weight`` 'balanced' weighs a class by rows / (classes * rows of the class) of the training rows. Training rows of one
    class give a model that is sure of it. Random over- and undersampling counts the rows that :func:`resample.resample` would
    repeat or keep, without making them. ``max_iter`` bounds the Newton steps.
    """
    design = design_of(folds)
    classes = folds.rows.groupBy("y").agg(
        F.count("*").alias("n"), *[F.count(F.when(F.col("folds")[r - 1] == f, 1)).alias(f"c{i}") for i, (r, f) in enumerate(folds.cells)]
    ).collect()
    models: list[LinearModel] = []
    width = len(design.names) + 1
    counts = [{r["y"]: r["n"] - r[f"c{i}"] for r in classes if r["y"] in (0, 1) and r["n"] > r[f"c{i}"]} for i in range(len(folds.cells))]
    rules = _rules(folds, counts, {c.sampling for c in candidates} - {"none"}, seed)
    for candidate in candidates:
        p = model_params(candidate.model, candidate.params)
        for i, cell in enumerate(folds.cells):
            n = counts[i]
            rule = rules.get((candidate.sampling, i))
            if rule:  # both classes are as large as the one that is kept or copied
                n = dict.fromkeys(n, max(n.values()) if rule[0] == "copy" else min(n.values()))
            even = tuple(sum(n.values()) / (len(n) * n[v]) if v in n else 0.0 for v in (0, 1))
            weights = even if p["class_weight"] else (1.0, 1.0)
            model = LinearModel(candidate.name, candidate.sampling, cell, float(p["C"]), weights, np.zeros(width), rule)
            if len(n) < 2:
                model.beta[-1], model.gradient = (np.inf if n and max(n) else -np.inf), 0.0
            else:
                model.beta[-1] = np.log(n[1] * model.weights[1]) - np.log(n[0] * model.weights[0])
            models.append(model)
    todo = [m for m in models if np.isfinite(m.beta[-1])]
    at_once = max(1, HESSIAN_CELLS // design.width**2)
    limits = {c.name: min(max_steps, int(model_params(c.model, c.params)["max_iter"])) for c in candidates}
    for lo in range(0, len(todo), at_once):
        _newton(folds, design, todo[lo : lo + at_once], limits, seed)
    return models


def _newton(folds: FoldSet, design: Design, models: list[LinearModel], limits: dict[str, int], seed: int) -> None:
    trial = {id(m): m.beta.copy() for m in models}
    step: dict[int, np.ndarray] = {}
    slope: dict[int, float] = {}
    size = dict.fromkeys(trial, 1.0)
    active = list(models)
    while active:
        seen = _sums(folds, design, active, [trial[id(m)] for m in active], seed)
        rest = []
        for m, sums in zip(active, seen):
            key, beta = id(m), trial[id(m)]
            loss, gradient, hessian, relative = _look(design, m, beta, sums)
            # A step that does not lower the objective is halved; rounding decides nothing near the optimum.
            if key in step and loss > m.loss + 1e-4 * size[key] * slope[key] + 1e-12 * abs(m.loss) and size[key] > 1e-6:
                size[key] /= 2
                trial[key] = m.beta + size[key] * step[key]
                rest.append(m)
                continue
            moved = np.max(np.abs(beta - m.beta)) if key in step else np.inf
            m.beta, m.loss, m.gradient = beta, loss, relative
            m.steps += 1
            if moved <= STEP * (1.0 + np.max(np.abs(beta))) or m.steps > limits[m.name]:
                continue
            step[key] = -np.linalg.solve(hessian + 1e-12 * np.trace(hessian) / len(beta) * np.eye(len(beta)), gradient)
            slope[key], size[key] = float(gradient @ step[key]), 1.0
            trial[key] = beta + step[key]
            rest.append(m)
        active = rest


def score_linear(folds: FoldSet, models: list[LinearModel], parts: tuple[str, ...] = ("valid",)) -> DataFrame:
    """(key, repeat, fold, part, y, p, label, model, sampling) of all models from one scan of the rows."""
    design = design_of(folds)
    schema = T.StructType([
        T.StructField("key", folds.rows.schema["key"].dataType), T.StructField("repeat", T.IntegerType()), T.StructField("fold", T.IntegerType()),
        T.StructField("part", T.StringType()), T.StructField("y", T.IntegerType()), T.StructField("p", T.DoubleType()),
        T.StructField("label", T.IntegerType()), T.StructField("model", T.StringType()), T.StructField("sampling", T.StringType()),
    ])
    arrow = to_arrow_schema(schema)
    # An infinite intercept only meets the constant.
    gamma = np.stack([design.maps[m.cell][:, :-1] @ m.beta[:-1] for m in models], axis=1)
    constant = np.array([m.beta[-1] for m in models])
    about = [(m.cell, m.name, m.sampling) for m in models]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                some = batch.slice(lo, ROWS)
                f = np.array(some.column(some.schema.names.index("folds")).to_pylist())
                with np.errstate(over="ignore"):
                    p = 1.0 / (1.0 + np.exp(-(design.rows(some) @ gamma + constant)))
                for i, ((repeat, fold), name, sampling) in enumerate(about):
                    valid = f[:, repeat - 1] == fold
                    for part in parts:
                        at = np.flatnonzero(valid if part == "valid" else ~valid)
                        if not len(at):
                            continue
                        take = pa.array(at)
                        columns = [
                            some.column(0).take(take), np.full(len(at), repeat), np.full(len(at), fold), [part] * len(at),
                            some.column(1).take(take), p[at, i], (p[at, i] > 0.5).astype(np.int32), [name] * len(at), [sampling] * len(at),
                        ]
                        arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
                        yield pa.RecordBatch.from_arrays([a.cast(t.type) for a, t in zip(arrays, arrow)], schema=arrow)

    rows = folds.rows.select("key", "y", "folds", *[F.col(f"`{c}`") for c in (*design.nums, *design.cats)])
    return rows.mapInArrow(scan, schema)


def coefficient_table(folds: FoldSet, models: list[LinearModel]) -> DataFrame:
    """(model, repeat, fold, feature, beta) with the intercept as feature '(intercept)'; a few rows per model."""
    names = [*design_of(folds).names, "(intercept)"]
    rows = [(m.name, *m.cell, name, float(b)) for m in models for name, b in zip(names, m.beta)]
    return local_frame(folds.rows.sparkSession, rows, T._parse_datatype_string("model string, repeat int, fold int, feature string, beta double"))


def gradient_table(folds: FoldSet, models: list[LinearModel], scores: DataFrame) -> DataFrame:
    """(model, repeat, fold, feature, gradient, terms): the objective's gradient from scored training rows, by aggregates alone.

    ``scores`` is a score frame with part 'train'. ``terms`` is what the gradient's terms add up to in size: a model is at its
    optimum where the gradient vanishes against it. Features are those that the cell's own pipeline encodes.
    """
    if any(m.rule for m in models):
        raise ValueError("the gradient is that of models on the rows as they are")
    spark = folds.rows.sparkSession
    facts = [(m.name, *m.cell, m.c, *m.weights) for m in models]
    given = local_frame(spark, facts, T._parse_datatype_string("model string, repeat int, fold int, c double, w0 double, w1 double"))
    missed = lookup_join(scores.where("part = 'train'"), given, ["model", "repeat", "fold"], "inner").select(
        "key", "model", "repeat", "fold", (F.col("c") * F.when(F.col("y") == 1, F.col("w1")).otherwise(F.col("w0")) * (F.col("p") - F.col("y"))).alias("miss")
    )
    parts = []
    for cell in folds.cells:
        names = [*feature_names(folds.pipeline(cell), list(folds.spec.nums), list(folds.spec.cats)), "(intercept)"]
        x = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
        encoded = folds.frame(cell).where("part = 'train'").select("key", "repeat", "fold", x.alias("x"))
        cells = F.posexplode(F.transform("x", lambda v: v * F.col("miss"))).alias("j", "g")
        sums = encoded.join(missed, ["key", "repeat", "fold"]).select("model", "repeat", "fold", cells).groupBy("model", "repeat", "fold", "j").agg(
            F.sum("g").alias("g"), F.sum(F.abs("g")).alias("size")
        )
        label = local_frame(spark, list(enumerate(names)), T._parse_datatype_string("j int, feature string"))
        parts.append(lambda s=sums, n=label: lookup_join(s, n, ["j"], "inner"))
    summed = stage_parts(parts, "gradients", spark)
    beta = coefficient_table(folds, models)
    free = F.when(F.col("feature") == "(intercept)", 0.0).otherwise(F.col("beta"))
    return lookup_join(summed, beta, ["model", "repeat", "fold", "feature"], "inner").select(
        "model", "repeat", "fold", "feature", (F.col("g") + free).alias("gradient"), (F.col("size") + F.abs(free)).alias("terms")
    )
