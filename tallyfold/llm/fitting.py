"""Bounded samples of labelled rows, and small numeric fits on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_sample(rows: DataFrame, label: str, key: str, limit: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``limit`` rows, half of them per class (0, 1), and the number of rows of each class.

    Rows are taken in the order of a hash of the key, found as one cut value per class, so texts are neither sorted nor
    moved. Rows that share the cut's hash are all taken.
    """
    narrow = rows.select(F.col(label).alias("y"), F.xxhash64(F.lit(5), F.col(key).cast("string")).alias("h"))
    sizes = {int(r["y"]): r["n"] for r in narrow.groupBy("y").agg(F.count("*").alias("n")).collect() if r["y"] in (0, 1)}
    half = {c: limit // 2 for c in sizes}
    if len(sizes) == 2:
        small = min(sizes, key=sizes.get)
        half[1 - small] = limit - min(sizes[small], limit // 2)
    h = F.xxhash64(F.lit(5), F.col(key).cast("string"))
    chosen = F.lit(False)
    for c, n in sizes.items():
        if n <= half[c]:
            chosen = chosen | (F.col(label) == c)
        else:
            cut = narrow.where(F.col("y") == c).select("h").orderBy("h").limit(half[c]).agg(F.max("h")).first()[0]
            chosen = chosen | ((F.col(label) == c) & (h <= cut))
    return rows.where(chosen), sizes


def fit_logistic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(slope, offset) of a weighted logistic curve through margins, by damped Newton steps; targets are slightly softened."""
    n1, n0 = weight[y == 1].sum(), weight[y == 0].sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, s = weight * (p - target), weight * p * (1 - p) + 1e-9
        grad = np.array([(g * margin).sum() + 1e-3 * a, g.sum()])
        hess = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum()]])
        step = np.linalg.solve(hess + 1e-9 * np.eye(2), grad)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)
