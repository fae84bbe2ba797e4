"""Neighbour join against brute force, and the properties of every sampling strategy."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold import runtime
from tallyfold.operators import neighbours, resample
from tallyfold.plans import evaluate


def points(spark, n=240, dim=3, copies=80):
    """Some rows share one point: a third of them are copies."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, dim)).round(3)
    x[:copies] = x[0]
    y = (np.arange(n) % 6 == 0).astype(int)
    rows = [(f"{i:04d}", int(y[i]), [float(v) for v in x[i]]) for i in range(n)]
    return x, y, spark.createDataFrame(rows, "key string, y int, vec array<double>")


@pytest.mark.parametrize("leaves,block", [(1, 4096), (12, 4096), (12, 16)])
def test_knn_equals_brute_force(spark, leaves, block):
    x, _, df = points(spark)
    got: dict[str, list] = {}
    for r in neighbours.knn(df, df, 4, "key", "vec", n_leaves=leaves, block_rows=block).orderBy("key", "rank").collect():
        got.setdefault(r["key"], []).append((r["dist"], r["neighbour"]))
    for i in range(len(x)):
        d = np.round(np.sqrt(((x - x[i]) ** 2).sum(axis=1)), 9)
        want = sorted((d[j], f"{j:04d}") for j in range(len(x)) if j != i)[:4]
        assert got[f"{i:04d}"] == want


def test_clustered_vectors_visit_few_leaves(spark):
    """Blocks of a cluster meet a small part of all leaves, and each visit is one row."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(60, 8)) + 200 * c for c in rng.normal(size=(40, 8))])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "qid long, vec array<double>")
    tree = neighbours.grow_tree(x[rng.permutation(len(x))[:640]], 40)
    base = df.select("vec", F.array("qid").alias("keys"))
    found, visits = neighbours.search(df, base, tree, 3, "bigint", 512)
    blocks = found.count()
    met = sum(v.count() for v in visits)
    leaves = len({r["leaf"] for v in visits for r in v.select("leaf").collect()})
    assert leaves > 25 and met < 0.1 * blocks * leaves
    for r in found.collect():
        for q, dist, near in zip(r["qids"], r["dist"], r["near"]):
            d = np.round(np.sqrt(((x - x[q]) ** 2).sum(axis=1)), 9)
            assert list(zip(dist, near)) == sorted((float(v), j) for j, v in enumerate(d))[:3]


def test_vectors_are_sent_once_to_a_group(spark, monkeypatch):
    """Without structure all leaves are visited: visits hold no vectors, steps that are done leave no tables behind, groups change nothing."""
    monkeypatch.setattr(neighbours, "GROUP_BLOCKS", 3)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 24)).round(4)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "qid long, vec array<double>")
    tree = neighbours.grow_tree(x[rng.permutation(len(x))[:300]], 20)
    before = len(runtime._staged.get(spark.sparkContext.applicationId, []))
    found, visits = neighbours.search(df, df.select("vec", F.array("qid").alias("keys")), tree, 3, "bigint", 16)
    assert sum(v.count() for v in visits) > 200
    assert all(kind != "binary" and not kind.startswith("array") for v in visits for _, kind in v.dtypes)
    assert len(runtime._staged[spark.sparkContext.applicationId]) - before <= len(visits) + 2
    for r in found.collect():
        for q, dist, near in zip(r["qids"], r["dist"], r["near"]):
            d = np.round(np.sqrt(((x - x[q]) ** 2).sum(axis=1)), 9)
            assert list(zip(dist, near)) == sorted((float(v), j) for j, v in enumerate(d))[:3]


@pytest.mark.parametrize("sent", [0, 4, 10**9])
def test_each_side_is_dealt_out_once(spark, monkeypatch, sent):
    """Where most groups meet, groups are partitions and tasks their product; either way the nearest rows are the same."""
    monkeypatch.setattr(neighbours, "GROUP_BLOCKS", 3)
    monkeypatch.setattr(neighbours, "MAX_SENT", sent)
    products = []
    product = neighbours._product
    monkeypatch.setattr(neighbours, "_product", lambda *args: products.append(1) or product(*args))
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 24)).round(4)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>")
    got: dict[int, list] = {}
    for r in neighbours.knn(df, df, 3, n_leaves=12, block_rows=16).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["dist"], r["neighbour"]))
    for i in range(len(x)):
        d = np.round(np.sqrt(((x - x[i]) ** 2).sum(axis=1)), 9)
        assert got[i] == sorted((float(v), j) for j, v in enumerate(d) if j != i)[:3]
    assert bool(products) == (sent < 10**9)


def test_staged_writes_leave_no_shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    setting = spark.conf.get(runtime.DROP_SHUFFLES, None)

    def shuffled() -> int:
        return sum(files.getAllFiles().apply(i).getName().startswith("shuffle_") for i in range(files.getAllFiles().size()))

    before = shuffled()
    staged = runtime.stage(spark.range(10_000).groupBy((F.col("id") % 97).alias("k")).count(), "counts")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before
    assert staged.count() == 97 and spark.conf.get(runtime.DROP_SHUFFLES, None) == setting


def test_knn_of_odd_inputs(spark):
    empty = spark.createDataFrame([], "key string, vec array<double>")
    one = spark.createDataFrame([("a", [1.0, 2.0])], "key string, vec array<double>")
    assert neighbours.knn(one, empty, 2, "key", "vec").count() == neighbours.knn(empty, one, 2, "key", "vec").count() == 0
    assert neighbours.knn(one, one, 2, "key", "vec").count() == 0
    far = spark.createDataFrame([(f"f{i}", [1e9 + i, -1e9]) for i in range(5)], "key string, vec array<double>")
    rows = neighbours.knn(one, far, 2, "key", "vec", n_leaves=3).orderBy("rank").collect()
    assert [r["neighbour"] for r in rows] == ["f0", "f1"]


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        resample.resample(points(spark)[2], "magic")


def test_smote_points_lie_on_segments(spark):
    x, _, df = points(spark)
    minority = df.where("y = 1")
    rows = resample.smote_rows(df).collect()
    assert len(rows) == df.where("y = 0").count() - minority.count()
    at = {r["key"]: np.array(r["vec"]) for r in minority.collect()}
    for r in rows:
        a, b = at[r["seed_key"]], at[r["neighbour"]]
        assert np.allclose(np.array(r["vec"]), a + r["u"] * (b - a)) and 0 <= r["u"] < 1


def test_parity_strategies(spark):
    _, _, df = points(spark)
    for s in ("smote", "random_oversample", "random_undersample"):
        counts = {r["y"]: r["count"] for r in resample.resample(df, s).groupBy("y").count().collect()}
        assert counts[0] == counts[1], s


def test_many_copies_of_few_seeds(spark, monkeypatch):
    """Ranges of copies expand to the same rows however small a range is."""
    monkeypatch.setattr(resample, "COPY_RANGE", 3)
    _, _, df = points(spark)
    copies = resample.oversample_copies(df.withColumnRenamed("key", "id"), "id").select("id", "copy").collect()
    assert len(copies) == len(set(copies)) == 160
    assert min(c["copy"] for c in copies) == 1 and max(c["copy"] for c in copies) == 4


def test_tomek_removal_leaves_pairs_unlinked(spark):
    _, _, df = points(spark, copies=1)
    links = resample.tomek_links(df).collect()
    assert links and {(r["key"], r["other"]) for r in links} == {(r["other"], r["key"]) for r in links}
    kept = {r["key"] for r in resample.drop_tomek(df, both=True).collect()}
    assert not kept & {r["key"] for r in links}


def test_too_few_minority_rows(spark):
    rows = [(str(i), int(i < 3), [float(i)]) for i in range(20)]
    df = spark.createDataFrame(rows, "key string, y int, vec array<double>")
    with pytest.raises(ValueError):
        resample.smote_rows(df)


def test_none_is_identity(spark):
    _, _, df = points(spark)
    assert resample.resample(df, "none").exceptAll(df).count() == 0
    assert resample.resample(df, "none").agg(F.count("*")).first()[0] == 240


def test_strategies_share_their_neighbours(spark, monkeypatch):
    """All strategies of a fold take four searches, and give what each gives alone."""
    _, _, df = points(spark, copies=20)
    searches = []
    knn = resample.knn
    monkeypatch.setattr(resample, "knn", lambda q, b, k, *names: searches.append(k) or knn(q, b, k, *names))
    alone = {s: sorted(resample.resample(df, s).collect()) for s in resample.STRATEGIES}
    assert len(searches) == 10
    searches.clear()
    planned = resample.Resampler(df, resample.STRATEGIES)
    together = dict(zip(resample.STRATEGIES, runtime.run_jobs([lambda s=s: sorted(planned.rows(s).collect()) for s in resample.STRATEGIES])))
    assert len(searches) == 4 and together == alone


def test_folds_share_searches(spark, monkeypatch):
    """Candidates that differ in their sampling alone do not search again in the same fold."""
    _, y, df = points(spark, copies=20)
    table = df.select(F.col("key").alias("id"), "y", *[F.col("vec")[i].alias(f"x{i}") for i in range(3)])
    searches = []
    knn = resample.knn
    monkeypatch.setattr(resample, "knn", lambda q, b, k, *names: searches.append(k) or knn(q, b, k, *names))
    tried = [evaluate.Candidate("LogisticRegression", {"max_iter": 5}, s, s) for s in ("smote", "smote_tomek", "smote_enn")]
    scores = evaluate.score_candidates(evaluate.fold_frames(table, evaluate.TableSpec("id", ("x0", "x1", "x2")), 2, 1), tried)
    assert scores.count() == 3 * len(y)
    assert len(searches) == 2 * 2
