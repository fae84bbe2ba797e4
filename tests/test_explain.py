"""Calibration against a plain version, permutations and dependence against brute force, and their edge cases."""

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.functions.scalars import hash_key
from tallyfold.operators import calibrate, explain
from tallyfold.operators.metrics import probability_metrics


def plain_isotonic(rows):
    """Value per distinct score by the closed form, in fractions."""
    points = defaultdict(lambda: [0, 0])
    for y, p in rows:
        points[p][0] += 1
        points[p][1] += y
    xs = sorted(points)

    def mean(i, j):
        return Fraction(sum(points[x][1] for x in xs[i : j + 1]), sum(points[x][0] for x in xs[i : j + 1]))

    return {x: max(min(mean(i, j) for j in range(k, len(xs))) for i in range(k + 1)) for k, x in enumerate(xs)}


@pytest.mark.parametrize("range_rows", [3, 1000])
def test_isotonic_equals_the_closed_form(spark, range_rows):
    draw = random.Random(range_rows)
    rows = [(g, int(draw.random() < 0.2 + 0.02 * s), s / 8) for g in ("a", None) for s in [draw.randrange(30) for _ in range(150)]]
    scores = spark.createDataFrame(rows, "g string, y int, p double")
    blocks = calibrate.isotonic_blocks(calibrate.score_points(scores, ["g"]), ["g"], range_rows=range_rows)
    fitted = calibrate.apply_isotonic(scores, blocks, ["g"]).collect()
    for g in ("a", None):
        want = plain_isotonic([(y, p) for h, y, p in rows if h == g])
        assert {r["p"]: r["calibrated"] for r in fitted if r["g"] == g} == {p: pytest.approx(float(v)) for p, v in want.items()}
        values = [r["value"] for r in sorted(blocks.where(F.col("g").eqNullSafe(g)).collect(), key=lambda r: r["lo"])]
        assert values == sorted(set(values))
    assert len(fitted) == len(rows)


def test_isotonic_between_and_beyond_blocks(spark):
    points = spark.createDataFrame([(1.0, 4, 1), (2.0, 2, 1), (4.0, 1, 1)], "score double, n long, pos long")
    blocks = calibrate.isotonic_blocks(points)
    asked = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (3.0,), (9.0,), (None,), (float("nan"),)], "p double")
    got = [r["calibrated"] for r in calibrate.apply_isotonic(asked, blocks).orderBy(F.expr("p is null"), "p").collect()]
    assert got == [0.25, 0.25, 0.375, 0.75, 1.0, None, None]


def test_a_third_of_the_rows_in_one_score_keeps_every_row(spark):
    rows = [(i % 3 == 0 or i % 2, 0.5 if i % 3 else i / 900) for i in range(900)]
    scores = spark.createDataFrame([(int(bool(y)), p) for y, p in rows], "y int, p double")
    blocks = calibrate.isotonic_blocks(calibrate.score_points(scores), range_rows=50)
    assert calibrate.apply_isotonic(scores, blocks).count() == 900
    assert blocks.agg(F.sum("n")).first()[0] == 900


def plain_platt(rows):
    pos = sum(y for y, _ in rows)
    neg = len(rows) - pos
    t = {1: (pos + 1) / (pos + 2), 0: 1 / (neg + 2)}
    mean = sum(t[y] for y, _ in rows) / len(rows)
    a, b = 0.0, math.log(mean / (1 - mean))
    for _ in range(60):
        terms = [(p, t[y], 1 / (1 + math.exp(-(a * p + b)))) for y, p in rows]
        ga, gb = sum((q - v) * p for p, v, q in terms), sum(q - v for _, v, q in terms)
        haa, hab, hbb = (sum(q * (1 - q) * p**k for p, _, q in terms) for k in (2, 1, 0))
        det = haa * hbb - hab * hab
        a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
    return a, b


def test_platt_equals_plain_newton_and_lowers_the_loss(spark):
    draw = random.Random(5)
    rows = []
    for _ in range(400):
        p = draw.random()
        rows.append((int(draw.random() < 1 / (1 + math.exp(-(3 * p - 2)))), round(p, 2)))
    scores = spark.createDataFrame(rows, "y int, p double")
    fit = calibrate.platt_fit(calibrate.score_points(scores))
    row, (a, b) = fit.first(), plain_platt(rows)
    assert (row["a"], row["b"]) == (pytest.approx(a, rel=1e-8), pytest.approx(b, rel=1e-8))
    assert row["gradient"] < 1e-9 and row["loss"] < row["prior_loss"]
    after = calibrate.apply_platt(scores, fit).drop("p").withColumnRenamed("calibrated", "p")
    losses = [probability_metrics(s).first()["log_loss"] for s in (scores, after)]
    assert losses[1] < losses[0]


@pytest.mark.parametrize(
    "rows", [[(1, 0.5)] * 4, [(0, 0.1), (1, 0.9)] * 5, [(1, 0.2), (1, 0.8)], [(0, 300.0), (1, 900.0), (0, 400.0)] * 9]
)
def test_platt_of_odd_groups_is_finite_and_flat(spark, rows):
    """Equal scores, separable classes, one class, scores of any size."""
    row = calibrate.platt_fit(calibrate.score_points(spark.createDataFrame(rows, "y int, p double"))).first()
    assert math.isfinite(row["a"]) and math.isfinite(row["b"]) and row["gradient"] < 1e-6
    assert row["loss"] <= row["prior_loss"] * (1 + 1e-12)


@pytest.mark.parametrize("method", calibrate.METHODS)
def test_cross_calibration_leaves_a_fold_out(spark, method):
    draw = random.Random(3)
    rows = [(i % 3, int(draw.random() < 0.3 + s / 20), s / 10, "x") for i in range(300) for s in [draw.randrange(10)]]
    scores = spark.createDataFrame(rows, "fold int, y int, p double, extra string")
    got = calibrate.cross_calibrated(scores, method)
    assert got.columns == ["fold", "y", "p", "extra", "calibrated"] and got.count() == 300
    # Turning the classes of a fold round changes nothing for its own rows.
    turned = scores.withColumn("y", F.when(F.col("fold") == 1, 1 - F.col("y")).otherwise(F.col("y")))
    other = calibrate.cross_calibrated(turned, method)

    def answers(df, same):
        mine = df.where("fold = 1") if same else df.where("fold <> 1")
        return {(r["fold"], r["p"]): r["calibrated"] for r in mine.collect()}

    assert answers(got, True) == pytest.approx(answers(other, True), rel=1e-9)
    assert answers(got, False) != pytest.approx(answers(other, False), rel=1e-3)


@pytest.mark.parametrize("method", calibrate.METHODS)
def test_calibration_of_nothing(spark, method):
    empty = spark.createDataFrame([], "fold int, y int, p double")
    assert calibrate.cross_calibrated(empty, method).count() == 0
    unknown = spark.createDataFrame([(1, 1, None), (2, 0, float("nan")), (2, None, 0.5)], "fold int, y int, p double")
    assert {r["calibrated"] for r in calibrate.cross_calibrated(unknown, method).collect()} == {None}
    with pytest.raises(ValueError, match="none of"):
        calibrate.cross_calibrated(empty, "beta")


def features(spark, n=200):
    rows = [(i, float(i % 20), i % 7, None if i % 11 == 0 else "uvw"[i % 3]) for i in range(n)]
    return spark.createDataFrame(rows, "id int, x double, m int, c string")


def scorer(df):
    p = F.col("x") / 40 + F.when(F.col("c") == "u", 0.5).otherwise(0.0)
    return df.withColumns({"p": p, "label": (p >= 0.5).cast("int")})


def test_every_row_is_donor_once_a_repeat(spark):
    df = features(spark)
    moved = explain.permuted_features(df, ["id"], ["x", "c", "id"], repeats=3).collect()
    for r in (1, 2, 3):
        mine = [m for m in moved if m["repeat"] == r]
        assert sorted(m["donor"]["id"] for m in mine) == sorted(m["id"] for m in mine) == list(range(200))
        assert sum(m["donor"]["id"] == m["id"] for m in mine) < 20
        assert Counter(m["donor"]["c"] for m in mine) == Counter(m["c"] for m in mine)
    orders = [tuple(m["donor"]["id"] for m in sorted(moved, key=lambda m: m["id"]) if m["repeat"] == r) for r in (1, 2, 3)]
    assert len(set(orders)) == 3


@pytest.mark.parametrize("metric", ["accuracy", "roc_auc"])
def test_importance_of_used_and_unused_columns(spark, metric):
    df = scorer(features(spark)).withColumn("y", F.col("label")).drop("p", "label")
    table = {r["feature"]: r for r in explain.permutation_importance(df, ["id"], ["x", "m", "c"], scorer, metric, 2).collect()}
    assert table["m"]["importance"] == 0.0 and table["m"]["importance_std"] == 0.0
    assert table["c"]["importance"] > 0.05 and table["x"]["baseline"] == pytest.approx(1.0)
    moved = explain.permuted_features(df, ["id"], ["x", "m", "c"], 2).select("repeat", "y", "x", "m", "donor.c")
    if metric == "accuracy":
        hits = [r["a"] for r in scorer(moved).groupBy("repeat").agg(F.avg((F.col("y") == F.col("label")).cast("int")).alias("a")).collect()]
        assert table["c"]["importance"] == pytest.approx(1 - sum(hits) / 2)


def test_partial_dependence_equals_brute_force(spark):
    df = features(spark)
    grids = {"x": [1.0, 5.0], "c": ["u", "v"], "m": [2]}
    got = {(r["feature"], r["value"], r["category"]): (r["n"], r["mean_p"]) for r in explain.partial_dependence(df, ["x", "m", "c"], scorer, grids).collect()}
    assert len(got) == 5
    for c, values in grids.items():
        for v in values:
            want = scorer(df.withColumn(c, F.lit(v))).agg(F.avg("p")).first()[0]
            key = (c, None, v) if isinstance(v, str) else (c, float(v), None)
            assert got[key] == (200, pytest.approx(want))


def test_grids(spark):
    grids = explain.feature_grids(features(spark), ["x", "m", "c"], 10)
    assert grids["m"] == list(range(7)) and grids["c"] == ["u", "v", "w"]
    low, high = np.quantile([i % 20 for i in range(200)], [0.05, 0.95])
    assert grids["x"] == pytest.approx(list(np.linspace(low, high, 10)))
    with pytest.raises(ValueError, match="grid"):
        explain.feature_grids(features(spark).withColumn("c", F.col("id").cast("string")), ["c"], 10)


def test_explanations_of_nothing(spark):
    empty = features(spark).where("id < 0").withColumn("y", F.lit(1))
    assert explain.permutation_importance(empty, ["id"], ["x", "c"], scorer, "mcc", 2).count() == 0
    assert explain.partial_dependence(empty, ["x", "m", "c"], scorer).count() == 0
    assert explain.partial_dependence(empty, ["x", "m", "c"], scorer, {"x": [1.0]}).count() == 0


def test_ranks_by_hash_without_sending_hashes(spark):
    """Ranks are those of the sorted hashes; what is exchanged to rank rows holds no hash."""
    rows = spark.range(500).selectExpr("id", "id % 2 as part")
    h = hash_key("7|take", "part", "id")
    ranked = explain.hash_ranked(rows, h, ["part"], "rank")
    want = {}
    for part in (0, 1):
        own = sorted((r["h"], r["id"]) for r in rows.where(F.col("part") == part).select("id", h.alias("h")).collect())
        want |= {key: i + 1 for i, (_, key) in enumerate(own)}
    assert {r["id"]: r["rank"] for r in ranked.collect()} == want
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "AS __h#" in plan and "RepartitionByExpression" in plan
    assert "AS __h#" not in plan[plan.index("RepartitionByExpression") :]
