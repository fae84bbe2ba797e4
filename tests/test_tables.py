"""Order statistics, cleaning, splits and features."""

import re
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyfold import runtime
from tallyfold.operators import clean, features, order, profile, split


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(4000).select(
        "id", (F.rand(5) < 0.25).cast("int").alias("y"), F.randn(6).alias("a"),
        F.when(F.rand(7) < 0.4, 1.0).otherwise(F.round(F.rand(8), 2)).alias("b"),
    )
    return df.persist()


@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_percentiles_are_exact(spark, rows, accuracy):
    """With accuracy 50 the sketch brackets are used, with 10,000 every value is counted."""
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    pdf = rows.toPandas()
    for r in order.exact_percentiles(rows, ["a", "b"], probs, ["y"], accuracy=accuracy).collect():
        values = pdf.loc[pdf["y"] == r["y"], r["column"]]
        assert list(r["q"]) == pytest.approx(list(np.percentile(values, [100 * p for p in probs])))


def test_even_quantiles(rows):
    got = features.even_quantiles(rows, ["a", "b"], 101)
    pdf = rows.toPandas()
    for c in ("a", "b"):
        assert got[c] == pytest.approx(list(np.percentile(pdf[c], np.linspace(0, 100, 101))))


def test_average_rank_matches_pandas(rows):
    pdf = clean.rank_scaled(rows, "b", "r").toPandas()
    ranks = pdf["b"].rank(method="average")
    assert list(pdf["r"]) == pytest.approx(list(ranks / ranks.max()))


def test_split_keeps_shares_and_repeats(rows):
    a = split.stratified_split(rows, ["id"], "y", 0.3).select("id", "y", "split").toPandas()
    b = split.stratified_split(rows.repartition(7), ["id"], "y", 0.3).select("id", "split").toPandas()
    assert dict(zip(a["id"], a["split"])) == dict(zip(b["id"], b["split"]))
    assert (a["split"] == "test").sum() == 1200
    for y in (0, 1):
        n = (a["y"] == y).sum()
        assert abs(((a["y"] == y) & (a["split"] == "test")).sum() - 0.3 * n) <= 1


def test_split_keeps_rows_without_class(rows):
    gaps = rows.withColumn("y", F.when(F.col("id") % 50 != 0, F.col("y")))
    out = split.stratified_split(gaps, ["id"], "y")
    assert out.count() == 4000 and out.where("y is null and split = 'test'").count() == 80


def test_folds_cover_and_balance(rows):
    pdf = split.repeated_folds(rows, ["id"], "y", 4, 2).toPandas()
    assert len(pdf) == 8000 and pdf.groupby(["id", "repeat"]).size().max() == 1
    sizes = pdf.groupby(["repeat", "y", "fold"]).size().unstack()
    assert (sizes.max(axis=1) - sizes.min(axis=1)).max() <= 1
    whole = pdf.groupby(["repeat", "fold"]).size()
    assert whole.max() - whole.min() <= 1


def test_subsets_nest(rows):
    pdf = split.nested_subsets(rows, ["id"], [0.1, 0.5, 1.0]).toPandas()
    assert [(pdf["subset"].between(1, j)).sum() for j in (1, 2, 3)] == [400, 2000, 4000]


def test_fold_position(spark):
    df = spark.range(1, 7).select(*[c.alias(n) for c, n in zip(split.fold_position("id", 3), ("r", "f"))])
    assert [tuple(r) for r in df.collect()] == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3)]


def test_mode_prefers_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert clean.mode_fill(df, ["c"]).groupBy("c").count().orderBy("c").collect()[0]["count"] == 3


def test_encode_needs_two_classes(spark):
    df = spark.createDataFrame([(" x",), ("y ",), ("z",)], "c string")
    with pytest.raises(ValueError):
        clean.encode_binary(df, "c")
    two = clean.encode_binary(df.where("c <> 'z'"), "c")
    assert [r["y"] for r in two.collect()] == [0, 1]


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (None,)], "x double")
    bins = profile.histogram(df, ["x"], 5).orderBy("bin").collect()
    assert [r["n"] for r in bins] == [1, 0, 0, 0, 1]


def test_dotted_column_names(spark):
    df = spark.createDataFrame([("a", 1.0), ("?", 2.0)], "`marital.status` string, `hours-per-week` double")
    cleaned = clean.sentinel_to_null(df)
    assert {r["column"]: r["nulls"] for r in profile.null_counts(cleaned).collect()} == {
        "marital.status": 1, "hours-per-week": 0,
    }
    assert profile.describe_mixed(cleaned).count() == 2


def test_robust_scale_zero_iqr(spark):
    df = spark.createDataFrame([(5.0,)] * 9 + [(7.0,)], "x double")
    out = features.ExactRobustScaler(cols=["x"]).fit(df).transform(df)
    assert out.agg(F.max("x")).first()[0] == 2.0


def test_quantile_normal_tails(spark):
    df = spark.range(2000).select(F.col("id").cast("double").alias("x"))
    model = features.QuantileNormal(cols=["x"]).fit(df)
    ends = model.transform(spark.createDataFrame([(-5.0,), (999.5,), (9999.0,)], "x double")).collect()
    got = sorted(r["x"] for r in ends)
    assert got == pytest.approx([-features.TAIL_QUANTILE, 0.0, features.TAIL_QUANTILE], abs=1e-6)


def test_onehot_unseen_is_zero(spark):
    train = spark.createDataFrame([("red",), ("blue",), ("red",), ("green",)], "c string")
    model = Pipeline(stages=features.onehot_stages(["c"])).fit(train)
    new = spark.createDataFrame([("red",), ("blue",), ("green",), ("pink",)], "c string")
    got = [list(r[0]) for r in model.transform(new).select(vector_to_array("__hot_c")).collect()]
    assert got == [[0, 0, 1], [1, 0, 0], [0, 1, 0], [0, 0, 0]]


def test_fitted_stages_can_be_saved(spark, rows, tmp_path):
    from pyspark.ml import PipelineModel

    model = features.preprocessing(["a", "b"], []).fit(rows)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a, b = (m.transform(rows.limit(5)).select("id", vector_to_array("features")).collect() for m in (model, again))
    assert a == b


def test_join_of_uneven_keys(spark):
    """One key holds a third of the rows: the result is whole and no task of the shuffle gets much more than the others."""
    n = 30_000
    df = spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 1001 == 0, None).otherwise(F.col("id") % 9000).cast("long").alias("k"),
        F.lit("x").alias("other"),
    )
    counts = df.groupBy("k").agg(F.count("*").alias("n"))
    small = counts.select("k", (F.coalesce("k", F.lit(-1)) * 2).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = runtime.skewed_join(df.repartition(4), small, ["k"], counts, "n", limit=10)
        rows = joined.select("id", "k", "v", "other", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len({r["id"] for r in rows}) == len(rows) == n and joined.columns == ["id", "k", "other", "v"]
    assert all(r["v"] == (-2 if r["k"] is None else r["k"] * 2) for r in rows)
    sizes = sorted(pd.Series([r["task"] for r in rows]).value_counts())
    assert len(sizes) == 4 and sizes[-1] <= 1.5 * sizes[len(sizes) // 2]


def test_average_rank_with_a_hot_score(spark):
    values = [0.5] * 400 + [i / 1000 for i in range(800)] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, s double")
    counts = df.where("s IS NOT NULL").groupBy("s").agg(F.count("*").alias("n"))
    ranks = pd.Series(values).rank()
    got = {r["id"]: r["avg_rank"] for r in order.average_rank(df, "s").collect()}
    assert all(got[i] == pytest.approx(ranks[i] / ranks.max()) for i in range(1200)) and got[1200] is None
    apart = runtime.skewed_join(df, counts.select("s", "n"), ["s"], counts, "n", limit=10)
    assert {r["id"]: r["n"] for r in apart.collect()} == {i: None if v is None else values.count(v) for i, v in enumerate(values)}


def test_normal_scores_are_compiled(spark, capsys):
    """The JVM compiles no method of more than 8,000 bytes; the normal quantile must not be generated as one."""
    p = np.array([0.0, 1e-8, 1e-5, 0.01, 0.024, 0.3, 0.5, 0.8, 0.976, 0.99, 1 - 1e-5, 1.0])
    rows = spark.createDataFrame([(float(v),) for v in p], "p double").unionByName(spark.sql("SELECT CAST(NULL AS DOUBLE) AS p"))
    out = features.with_normal_score(rows, "p", "z")
    got = [r["z"] for r in out.collect()]
    inverse = NormalDist().inv_cdf
    want = [inverse(min(max(v, features.TAIL), 1 - features.TAIL)) for v in p]
    assert got[-1] is None and np.allclose(got[:-1], want, atol=1e-5)
    features.with_normal_score(spark.range(9, numPartitions=1).select((F.col("id") / 8).alias("p")), "p", "z").explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_rows_of_heavy_keys_stay_where_they_are(spark):
    """Where heavy keys hold most rows, a null one among them, only the other rows are shuffled, and nothing is lost."""
    n = 6_000
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") + 10).cast("long")
    df = spark.range(n).select("id", key.alias("k"), F.lit("x").alias("other"))
    counts = df.groupBy("k").agg(F.count("*").alias("n"))
    small = counts.where("k IS NULL OR k <> 11").select("k", (F.coalesce("k", F.lit(-1)) * 2).alias("v"))
    joined = runtime.skewed_join(df, small, ["k"], counts, "n", limit=10)
    rows = joined.collect()
    assert len({r["id"] for r in rows}) == len(rows) == n and joined.columns == ["id", "k", "other", "v"]
    assert all(r["v"] == (None if r["k"] == 11 else -2 if r["k"] is None else r["k"] * 2) for r in rows)
    assert "Union" in joined._jdf.queryExecution().optimizedPlan().toString()
