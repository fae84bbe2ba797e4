"""Sharding and mixing: laws, repeated and missing values, empty tables."""

import collections

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import mixing, ring

SCHEMA = "doc_id long, text string, source string, shard string, n string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("shards", [1, 5])
def test_ring_rows_differ_by_one(spark, shards):
    rows = [(i, f"t{i}", "s") for i in range(203)] + [(7, "t7", "s")] * 40 + [(None, None, None)] * 30
    got = ring.ring_shards(ring.digest(docs(spark, rows)), shards, 8).toPandas()
    assert len(got) == len(rows)
    sizes = got.groupby("shard").size()
    assert len(sizes) == shards and sizes.max() - sizes.min() <= 1
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    assert set(got.loc[got["doc_id"].isna(), "size"]) == {8}


def test_ring_moves_little_and_agrees(spark):
    digest = ring.digest(docs(spark, [(i, str(i), "s") for i in range(2000)])).cache()
    a, again, b = (ring.ring_shards(digest, n, 32).toPandas().set_index("doc_id")["shard"] for n in (8, 8, 9))
    assert (a.sort_index() == again.sort_index()).all()
    moved = (a.sort_index() != b.sort_index()).mean()
    assert moved < 0.5  # all but an eighth would move if rows were dealt anew


def test_ring_of_nothing(spark):
    assert ring.ring_shards(ring.digest(docs(spark, [])), 3, 4).count() == 0


def plain_targets(sizes):
    """Rounds of sharing by weight until no source is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = {s: weight[s] for s in order if s not in fixed}
        left = total - sum(fixed.values())
        share = {s: left * w / sum(rest.values()) for s, w in rest.items()}
        above = [s for s, t in share.items() if t > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in above}


def test_targets_agree_with_rounds(spark):
    sizes = {"a": 10, "b": 5000, "c": 40, "d": 0, "é": 900, None: 70, "": 3}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (1 + i % 37), f"s{i % 4}" if i % 9 else None) for i in range(400)] + [(5, "a b c", "s0")] * 60 + [(1000, None, "s1"), (None, "", "s2")]
    first = mixing.mix(docs(spark, rows)).toPandas()
    assert len(first) == len(rows)
    assert (first["taken"] <= 3 * first["size"]).all()
    for _, g in first.groupby("source", dropna=False):
        assert g["size"].sum() == g["source_size"].iloc[0]
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= 1
    assert first["target"].groupby(first["source"].fillna("-")).first().sum() == pytest.approx(first["size"].sum())
    columns = ["doc_id", "source", "size", "taken"]
    again = mixing.mix(docs(spark, list(reversed(rows)))).toPandas()
    assert sorted(map(repr, first[columns].itertuples(index=False))) == sorted(map(repr, again[columns].itertuples(index=False)))


def test_better_documents_come_first(spark):
    """Of two equal halves, the one with few marks is taken more often; here by exponential keys, not by order."""
    rows = [(i, ("word " * 20) if i % 2 else ("wo$d%%% " * 20), "small") for i in range(600)] + [(9000 + i, "x " * 400, "t") for i in range(60)]
    got = mixing.mix(docs(spark, rows)).where("source = 'small'").withColumn("good", F.col("doc_id") % 2 == 1).toPandas()
    rest = got[got["epochs"] == got["epochs"].min()]
    share = rest.assign(hit=rest["part"] > 0).groupby("good")["hit"].mean()
    assert share[True] > 1.5 * share[False]


def test_mix_of_nothing(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    only_empty = mixing.mix(docs(spark, [(1, None, "a"), (2, "  ", None)])).toPandas()
    assert only_empty["taken"].tolist() == [0, 0] and isinstance(only_empty, pd.DataFrame)
    assert collections.Counter(only_empty["size"]) == {0: 2}
