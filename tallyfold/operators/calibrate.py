"""Calibrating scores after the fact: isotonic regression and Platt scaling, per group and cross-fitted over folds.

Both are fitted on points, one row per distinct score with its rows and positives: (by..., score, n, pos). Null and NaN scores are
left out of fits and calibrate to null.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.scalars import sigmoid
from tallyfold.operators.order import ordered_cumsum
from tallyfold.runtime import MAX_LOOKUP_ROWS, bounded_rows, local_frame, lookup_join, skewed_join, stage, staged_once

RANGE_ROWS = 200_000  # distinct scores that one task pools at first
MAX_RANGES = 9_000
FAN = 8  # ranges whose blocks one task joins in the next round
BLOCK = [
    T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("pos", T.LongType())
]
PLACE = [
    T.StructField("block", T.LongType()), T.StructField("value", T.DoubleType()),
    T.StructField("next_lo", T.DoubleType()), T.StructField("next_value", T.DoubleType()),
]


def score_points(scores: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """(by..., score, n, pos) of all rows with a score and a class."""
    score = F.col(p).cast("double")
    kept = scores.where(score.isNotNull() & ~F.isnan(score) & F.col(y).isNotNull())
    return kept.groupBy(*(by or []), score.alias("score")).agg(
        F.count("*").alias("n"), F.sum(F.col(y).cast("long")).alias("pos")
    )


def complement_points(scores: DataFrame, fold: str, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """(by..., fold, score, n, pos): for every fold the points of all rows outside it.

    Rows collapse to points per fold before they are dealt to the other folds.
    """
    by = list(by or [])
    points = stage(score_points(scores, [*by, fold], y, p), "fold-points")
    found = bounded_rows(points.select(fold).distinct())
    if found is None:
        raise ValueError(f"{fold!r} has more than {MAX_LOOKUP_ROWS} values, which is no set of folds")
    kind = points.schema[fold].dataType
    folds = F.array(*[F.lit(r[0]).cast(kind) for r in found])
    others = F.explode(F.array_except(folds, F.array(fold)))
    dealt = points.select(*by, "score", "n", "pos", others.alias(fold))
    return dealt.groupBy(*by, fold, "score").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))


def isotonic_blocks(points: DataFrame, by: list[str] | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The non-decreasing step function nearest to the classes by squares, as blocks of constant value.

    Rows (by..., lo, hi, n, pos, block, value, next_lo, next_value), blocks numbered from 1 by score; means are compared as
    fractions of counts, so equal ones share a block.

    Points are cut into ranges of scores and pooled inside each; what is left is pooled again over FAN neighbouring ranges at a
    time. Means of the blocks of one range of W rows are different fractions whose denominators add up to at most W, so there are at
    most about 0.9 * W^(2/3) of them, whatever the scores. The last task meets FAN ranges: below 2 * 10^6 blocks for a group
    of 10^9 rows.
    """
    by = list(by or [])
    keys = [points.schema[c] for c in by]
    points = staged_once(points, "points")
    n = F.col("n").cast("long").alias("n"), F.col("pos").cast("long").alias("pos")
    blocks = points.select(*by, F.col("score").alias("lo"), F.col("score").alias("hi"), *n)
    ranges = min(MAX_RANGES, math.ceil(points.count() / range_rows))
    if ranges > 1:
        probs = [i / ranges for i in range(1, ranges)]
        cuts = points.agg(F.percentile_approx("score", probs, 2 * ranges)).first()[0]
        splits = [float("-inf"), *sorted(set(map(float, cuts))), float("inf")]
        blocks = Bucketizer(splits=splits, inputCol="lo", outputCol="__cut").transform(blocks)
        blocks = blocks.withColumn("__range", F.col("__cut").cast("long")).drop("__cut")
        inner = [*by, "__range"]
        kind = T.StructType([*keys, T.StructField("__range", T.LongType()), *BLOCK])
        while ranges > 1:
            pooled = blocks.groupBy(*inner).applyInArrow(_in_arrow(_pooled, inner), kind)
            blocks = pooled.withColumn("__range", F.floor(F.col("__range") / FAN))
            ranges = math.ceil(ranges / FAN)
    whole = blocks.withColumn("__all", F.lit(0)).groupBy(*by, "__all")
    return whole.applyInArrow(_in_arrow(_placed, by), T.StructType([*keys, *BLOCK, *PLACE]))


def _pool(table: pa.Table) -> list[tuple[float, float, int, int]]:
    """Pool adjacent violators: blocks in order of score, joined while a mean is not below the next one's."""
    out: list[tuple[float, float, int, int]] = []
    ordered = table.sort_by("lo")
    for lo, hi, n, pos in zip(*[ordered.column(c).to_pylist() for c in ("lo", "hi", "n", "pos")]):
        while out and out[-1][3] * n >= pos * out[-1][2]:
            lo, _, more, ones = out.pop()
            n, pos = n + more, pos + ones
        out.append((lo, hi, n, pos))
    return out


def _columns(table: pa.Table, by: list[str], blocks: list[tuple]) -> dict[str, pa.Array]:
    first = pa.array(np.zeros(len(blocks), dtype=np.int64))
    lo, hi, n, pos = zip(*blocks)
    return {c: table.column(c).combine_chunks().take(first) for c in by} | {
        "lo": pa.array(lo, pa.float64()), "hi": pa.array(hi, pa.float64()), "n": pa.array(n, pa.int64()), "pos": pa.array(pos, pa.int64())
    }


def _in_arrow(fn: Callable[[pa.Table, list[str]], pa.Table], by: list[str]) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        return fn(table, by)

    return run


def _pooled(table: pa.Table, by: list[str]) -> pa.Table:
    return pa.table(_columns(table, by, _pool(table)))


def _placed(table: pa.Table, by: list[str]) -> pa.Table:
    blocks = _pool(table)
    columns = _columns(table, by, blocks)
    value = pc.divide(columns["pos"].cast(pa.float64()), columns["n"].cast(pa.float64()))
    last = pa.nulls(1, pa.float64())
    place = {
        "block": pa.array(np.arange(1, len(blocks) + 1)), "value": value,
        "next_lo": pa.concat_arrays([columns["lo"][1:], last]), "next_value": pa.concat_arrays([value[1:], last]),
    }
    return pa.table(columns | place)


def apply_isotonic(
    scores: DataFrame, blocks: DataFrame, by: list[str] | None = None, p: str = "p", out: str = "calibrated"
) -> DataFrame:
    """Add ``out``: a block's value inside it, a straight line between two blocks, the end values beyond them.

    Distinct scores and block starts are laid along one order, so that a running count of starts tells the block of a score.
    Scores of groups without blocks calibrate to null.
    """
    by = list(by or [])
    blocks = staged_once(blocks, "blocks")
    score = F.col(p).cast("double")
    known = scores.where(score.isNotNull() & ~F.isnan(score))
    counts = stage(known.groupBy(*by, F.col(p)).agg(F.count("*").alias("__n")), "scores")
    places = counts.select(*by, score.alias("score"), F.lit(0).alias("starts"), F.lit(True).alias("asked")).unionByName(
        blocks.select(*by, F.col("lo").alias("score"), F.lit(1).alias("starts"), F.lit(False).alias("asked"))
    )
    laid = places.groupBy(*by, "score").agg(F.sum("starts").alias("starts"), F.max("asked").alias("asked"))
    placed = ordered_cumsum(laid, "score", ["starts"], by).where("asked")
    placed = placed.select(*by, "score", F.greatest("cum_starts", F.lit(1)).cast("long").alias("block"))
    joined = lookup_join(placed, blocks.drop("n", "pos", "lo"), [*by, "block"], "left")
    slope = (F.col("next_value") - F.col("value")) / (F.col("next_lo") - F.col("hi"))
    inside = (F.col("score") <= F.col("hi")) | F.col("next_lo").isNull()
    value = F.when(inside, F.col("value")).otherwise(F.col("value") + slope * (F.col("score") - F.col("hi")))
    answers = joined.select(*by, F.col("score").cast(counts.schema[p].dataType).alias(p), value.alias(out))
    return skewed_join(scores, answers, [*by, p], counts, "__n")


def platt_fit(points: DataFrame, by: list[str] | None = None, max_steps: int = 100) -> DataFrame:
    """(by..., a, b, n, loss, prior_loss, gradient): sigmoid(a * score + b) of least log loss per group.

    The targets are (pos + 1) / (pos + 2) and 1 / (neg + 2) instead of 1 and 0, which keeps a separable group finite. ``prior_loss``
    is the loss of the best constant, ``gradient`` its largest part as a share of what its terms add up to. Every Newton step is
    one aggregate over the points of all groups; the driver holds two numbers per group, of which there may be 100,000.
    """
    by = list(by or [])
    points = staged_once(points, "points")
    keyed, keys = (points, by) if by else (points.withColumn("__all", F.lit(0)), ["__all"])
    groups = bounded_rows(keyed.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")))
    if groups is None:
        raise ValueError(f"more than {MAX_LOOKUP_ROWS} groups to calibrate")
    goal: dict[tuple, tuple[float, float]] = {}
    state: dict[tuple, dict] = {}
    for g in groups:
        key, pos, neg = tuple(g[k] for k in keys), g["pos"], g["n"] - g["pos"]
        goal[key] = (1 / (neg + 2), (pos + 1) / (pos + 2))
        mean = (neg * goal[key][0] + pos * goal[key][1]) / g["n"]
        start = np.array([0.0, math.log(mean / (1 - mean))])
        state[key] = {"n": g["n"], "beta": start, "trial": start, "loss": math.inf, "size": 1.0, "step": None, "steps": 0}
    active = set(state)
    kinds = T.StructType([*[keyed.schema[k] for k in keys], *[T.StructField(c, T.DoubleType()) for c in ("a", "b", "t0", "t1")]])
    while active:
        asked = [(*key, *map(float, state[key]["trial"]), *goal[key]) for key in active]
        if by:
            tried = lookup_join(keyed, local_frame(points.sparkSession, asked, kinds), keys, "inner")
        else:
            tried = keyed.withColumns({c: F.lit(v) for c, v in zip(("a", "b", "t0", "t1"), asked[0][1:])})
        seen = tried.groupBy(*keys).agg(*_platt_sums())
        for row in seen.collect():  # one row per group
            key = tuple(row[k] for k in keys)
            if _platt_step(state[key], row) or state[key]["steps"] >= max_steps:
                active.discard(key)
    fields = [*[points.schema[c] for c in by], T.StructField("a", T.DoubleType()), T.StructField("b", T.DoubleType()), T.StructField("n", T.LongType())]
    fields += [T.StructField(c, T.DoubleType()) for c in ("loss", "prior_loss", "gradient")]
    rows = [
        (*(key if by else ()), *map(float, s["beta"]), s["n"], s["loss"], s["prior"], s["gradient"]) for key, s in state.items()
    ]
    return local_frame(points.sparkSession, rows, T.StructType(fields))


def _platt_sums() -> list:
    f, n = F.col("score"), F.col("n")
    z = F.col("a") * f + F.col("b")
    q = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    target = F.col("pos") * F.col("t1") + (n - F.col("pos")) * F.col("t0")
    miss, bend = n * q - target, n * q * (1 - q)
    terms = n * q + target
    return [
        F.sum(n * (F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))) - target * z).alias("loss"),
        F.sum(miss * f).alias("ga"), F.sum(miss).alias("gb"), F.sum(terms * F.abs(f)).alias("ta"), F.sum(terms).alias("tb"),
        F.sum(bend * f * f).alias("haa"), F.sum(bend * f).alias("hab"), F.sum(bend).alias("hbb"),
    ]


def _platt_step(s: dict, row) -> bool:
    """Take in what the trial point gave and choose the next one; true when the group has arrived."""
    gradient = np.array([row["ga"], row["gb"]])
    if s["step"] is not None and row["loss"] > s["loss"] + 1e-12 * abs(s["loss"]) and s["size"] > 1e-6:
        s["size"] /= 2
        s["trial"] = s["beta"] + s["size"] * s["step"]
        return False
    moved = math.inf if s["step"] is None else float(np.max(np.abs(s["trial"] - s["beta"])))
    s["prior"] = s.get("prior", row["loss"])
    s["beta"], s["loss"], s["steps"] = s["trial"], row["loss"], s["steps"] + 1
    s["gradient"] = float(np.max(np.abs(gradient) / np.maximum([row["ta"], row["tb"]], 1e-300)))
    if moved <= 1e-12 * (1.0 + np.max(np.abs(s["beta"]))) or s["gradient"] < 1e-14:
        return True
    hessian = np.array([[row["haa"], row["hab"]], [row["hab"], row["hbb"]]])
    # Scores that are all equal leave a direction free; the shortest step does not move along it.
    s["step"], s["size"] = -np.linalg.lstsq(hessian, gradient, rcond=1e-12)[0], 1.0
    s["trial"] = s["beta"] + s["step"]
    return False


def apply_platt(
    scores: DataFrame, params: DataFrame, by: list[str] | None = None, p: str = "p", out: str = "calibrated"
) -> DataFrame:
    """Add ``out`` = sigmoid(a * score + b) of the row's group; null for null and NaN scores and groups without a fit."""
    by = list(by or [])
    given = params.select(*by, F.col("a").alias("__a"), F.col("b").alias("__b"))
    if by:
        joined = lookup_join(scores, given, by, "left")
    else:
        fit = bounded_rows(given, 1) or [{"__a": None, "__b": None}]
        joined = scores.withColumns({c: F.lit(fit[0][c]).cast("double") for c in ("__a", "__b")})
    value = F.when(~F.isnan(F.col(p).cast("double")), sigmoid(F.col("__a") * F.col(p) + F.col("__b")))
    return joined.withColumn(out, value).select(*[F.col(f"`{c}`") for c in scores.columns if c != out], out)


METHODS = ("isotonic", "sigmoid")


def cross_calibrated(
    scores: DataFrame, method: str, fold: str = "fold", by: list[str] | None = None, y: str = "y", p: str = "p", out: str = "calibrated"
) -> DataFrame:
    """Add ``out``: every row calibrated by a fit on the rows of all other folds. A single fold has nothing to fit on: null."""
    if method not in METHODS:
        raise ValueError(f"method {method!r} is none of {', '.join(METHODS)}")
    groups = [*(by or []), fold]
    points = complement_points(scores, fold, by, y, p)
    if method == "sigmoid":
        return apply_platt(scores, platt_fit(points, groups), groups, p, out)
    return apply_isotonic(scores, isotonic_blocks(points, groups), groups, p, out)
