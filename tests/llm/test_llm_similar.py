"""Jaccard join and embedding near-duplicates against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_words import plain_shingles

from tallyfold.llm import hnsw, partenum


def plain_components(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def made_texts(seed=3):
    """Copies, near copies of one text, texts that share a passage, short texts, and texts of their own."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    text = lambda n: [word() for _ in range(n)]
    base, passage = text(120), text(60)
    out = [" ".join(text(rng.randint(1, 80))) for _ in range(60)]
    for _ in range(60):
        near = list(base)
        for _ in range(rng.randint(0, 6)):
            near[rng.randrange(len(near))] = word()
        out.append(" ".join(near))
    for _ in range(60):
        out.append(" ".join(text(rng.randint(0, 60)) + passage + text(rng.randint(0, 40))))
    out += [" ".join(base).upper()] * 5 + ["", None, " \t", "one", "One", "a b c d e", "A b  c d e", "a b c d"]
    rng.shuffle(out)
    return out


def links_of(texts):
    sets = [plain_shingles(t) for t in texts]
    pairs = []
    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                pairs.append((j, i))
    return sets, pairs


@pytest.mark.parametrize("short", [2, 12])
def test_join_agrees_with_brute_force(spark, monkeypatch, short):
    monkeypatch.setattr(partenum, "SHORT_RUN", short)
    monkeypatch.setattr(partenum, "BLOCK", 16)
    texts = made_texts()
    sets, pairs = links_of(texts)
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in enumerate(texts)], "doc_id long, text string, sid int, text_key string")
    got = partenum.jaccard_components(docs).toPandas().sort_values("doc_id")
    assert got["n_shingles"].tolist() == [len(s) for s in sets]
    assert got["component_id"].tolist() == plain_components(len(texts), pairs)
    assert got["first"].sum() == got["component_id"].nunique()


def linked_pair(rng, size):
    """Two sets of about ``size`` elements that just link, or link with room to spare."""
    a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
    keep = rng.permutation(a)[: len(a) - rng.integers(0, len(a) // 4 + 1)]
    room = 100 * len(keep) // 75 - len(a)
    b = np.unique(np.concatenate([keep, rng.integers(0, 2**64, rng.choice([0, room // 2, room]), dtype=np.uint64)]))
    common = len(np.intersect1d(a, b))
    assert 100 * common >= 75 * (len(a) + len(b) - common)
    return a, b


def test_signatures_share_one_for_every_link_at_every_size():
    rng = np.random.default_rng(1)
    for size in range(1, 701):
        for _ in range(3):
            a, b = linked_pair(rng, size)
            s, d, spares = partenum.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            shared = set(s[d == 0]) & set(s[d == 1])
            assert shared, size
            # At the first level that one of them is done with, it may leave out its spares and still meets the other.
            band = np.searchsorted(partenum.size_bands(1000), max(len(a), len(b)))
            allowed = [(x, n) for v in spares for _, x, n in zip(*v) if x // 4 == band]
            for scheme, n in allowed:
                if scheme == min(allowed)[0]:
                    assert sum(int(v) % 1024 == scheme for v in shared) > n, size


def test_signatures_are_the_subsets_of_second_level_partitions():
    rng = np.random.default_rng(7)
    a = np.sort(rng.integers(0, 2**64, 20, dtype=np.uint64))
    one, _, _ = partenum.signatures(a, np.array([0, 20]))
    for x in range(20):  # an element that is missing spoils the two pairs that hold its second-level partition
        other, _, _ = partenum.signatures(np.delete(a, x), np.array([0, 19]))
        both = {int(v) % 1024 for v in one if int(v) % 4 == 0} & {int(v) % 1024 for v in other}
        assert both
        for scheme in both:
            mine = {int(v) for v in one if int(v) % 1024 == scheme}
            assert len(mine - set(map(int, other))) == 2
    assert partenum.most_lost(np.array([0, 1, 3, 5]), np.array([3, 3, 3, 3]), 3).tolist() == [0, 2, 6, 8]


def test_sets_of_one_number_stay_apart(spark):
    sets = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (3, 30)], "number long, sid long")
    pairs = spark.createDataFrame([(1, 2)], "a long, b long")
    assert sorted(map(tuple, partenum.with_ids(pairs, sets).collect())) == [(10, 11), (10, 20), (11, 20)]


def test_join_with_missing_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (2, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = partenum.jaccard_components(docs).toPandas()
    assert len(got) == 5
    with_words = got[got["n_shingles"] == 2]
    assert set(with_words["component_id"]) == {4} and with_words["first"].sum() == 2  # both rows of the repeated one
    assert partenum.jaccard_components(docs.limit(0)).count() == 0


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 3000, rng.integers(1, 900)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(2))
        data, at = partenum.parity_sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        bound = partenum.difference_bound(data[at[0] : at[1]].tobytes(), data[at[1] : at[2]].tobytes())
        assert bound <= len(np.setxor1d(a, b))


def test_near_vectors_agree_with_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    v = np.concatenate([centres[rng.integers(0, 40, 500)] + rng.normal(scale=0.15, size=(500, 16)), np.repeat(centres[:1], 50, 0)])
    rows = [(i, x.tolist(), "z") for i, x in enumerate(v)]
    odd = [None, [0.0] * 16, [float("nan")] * 16, [1.0] * 15 + [None], [], [float("inf")] * 16, (v[0, :8]).tolist()]
    rows += [(1000 + i, x, "z") for i, x in enumerate(odd)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string")
    got = hnsw.near_duplicates(frame).toPandas().sort_values("vec_id")
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    expected = plain_components(len(v), zip(*np.nonzero(near)))
    assert got["n_links"].tolist() == near.sum(1).tolist() + [0] * len(odd)
    assert got["component_id"].tolist() == expected + [1000 + i for i in range(len(odd))]
    assert (got["kept"] == (got["vec_id"] == got["component_id"])).all()
    assert hnsw.near_duplicates(frame.limit(0)).count() == 0


def spread_vectors(spark, groups):
    """Vectors far from each other, and groups of the given sizes whose members are near but unequal."""
    rng = np.random.default_rng(6)
    v = [rng.normal(size=(1200, 24))] + [rng.normal(size=24) + rng.normal(scale=0.1, size=(n, 24)) for n in groups]
    v = np.concatenate(v)
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>"), near.sum(1)


def blind(spark, most):
    """A search that finds links of vectors with more than ``most`` links only, however wide the beam."""
    real = hnsw.search_graphs

    def search(graphs, queries, *args):
        links = real(graphs, queries, *args)
        both = links.union(links.select("b", "a"))
        return links.join(both.groupBy("a").count().where(F.col("count") > most).select("a"), "a", "left_semi")

    return search


@pytest.mark.parametrize(("groups", "most"), [([2, 2, 2], 99), ([300, 2, 2, 2, 3], 5)])
def test_no_search_passes_that_misses_small_groups(spark, monkeypatch, groups, most):
    frame, expected = spread_vectors(spark, groups)
    monkeypatch.setattr(hnsw, "search_graphs", blind(spark, most))
    monkeypatch.setattr(hnsw, "MAX_WIDENINGS", 1)
    monkeypatch.setattr(hnsw, "AUDIT_VECTORS", 16)
    got = hnsw.near_duplicates(frame).toPandas().sort_values("vec_id")
    assert got["n_links"].tolist() == expected.tolist()


def test_audit_is_per_vector_and_size(spark):
    big = [(q, o) for q in range(40) for o in range(40) if q != o]
    truth = spark.createDataFrame(big + [(100, 101), (101, 100)], "q long, other long")
    found = spark.createDataFrame([(a, b) for a, b in big if a < b], "a long, b long")
    assert not hnsw.audit_passes(truth, found) and not hnsw.audit_passes(truth, found.limit(0))
    assert hnsw.audit_passes(truth, found.union(spark.createDataFrame([(100, 101)], "a long, b long")))
    assert hnsw.audit_passes(truth.limit(0), found)


def test_graph_finds_what_is_near():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(3000, 24)).astype(np.float32)
    base /= np.linalg.norm(base, axis=1)[:, None]
    graph = hnsw.Graph(base).build()
    q = base[::30]
    ids, sims = graph.search(q, 64)
    best = np.sort(q @ base.T, axis=1)[:, ::-1][:, :10]
    assert (sims[:, :10] >= best - 1e-5).mean() > 0.9
    assert (np.diff(sims, axis=1) <= 0).all() and (ids[:, 0] == np.arange(0, 3000, 30)).all()


def test_no_table_grows_with_shards_or_pairs(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 60)
    monkeypatch.setattr(hnsw, "AUDIT_VECTORS", 16)
    monkeypatch.setattr(hnsw, "AUDIT_LINKED", 2)
    monkeypatch.setattr(hnsw, "AUDIT_OTHERS", 0)
    rng = np.random.default_rng(8)
    v = np.concatenate([rng.normal(size=(300, 24)), rng.normal(size=24) + rng.normal(scale=0.1, size=(120, 24))])
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    plans, rows, real = [], [], hnsw.stage

    def stage(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        staged = real(df, *args)
        rows.append(staged.count())
        return staged

    monkeypatch.setattr(hnsw, "stage", stage)
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = hnsw.near_duplicates(frame).toPandas().sort_values("vec_id")
    assert got["n_links"].tolist() == near.sum(1).tolist()
    assert not any("Generate" in plan for plan in plans)  # no vector is sent to many shards
    assert max(rows) < near.sum() // 4  # nor is a group's every pair kept


def test_vectors_of_many_lengths_and_single_precision(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_BYTES", 2048)
    rng = np.random.default_rng(9)
    centres = {dim: rng.normal(size=(6, dim)) for dim in (3, 8, 9, 16)}
    v = [(centres[dim][k % 6] + rng.normal(scale=0.12, size=dim)).astype(np.float32) for dim in centres for k in range(9 * dim)]
    v += [v[0], 2 * v[0], v[-1], -v[-1]]
    unit = [x.astype(float) / np.linalg.norm(x.astype(float)) for x in v]
    near = np.array([[len(a) == len(b) and a @ b >= 0.9 for b in unit] for a in unit])
    np.fill_diagonal(near, False)
    expected = plain_components(len(v), zip(*np.nonzero(near)))
    for kind in ("float", "double"):
        frame = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], f"vec_id long, embedding array<{kind}>")
        got = hnsw.near_duplicates(frame).toPandas().sort_values("vec_id")
        assert got["n_links"].tolist() == near.sum(1).tolist()
        assert got["component_id"].tolist() == expected


def test_links_found_from_both_ends_count_once(monkeypatch):
    monkeypatch.setattr(hnsw, "PAIR_ROWS", 2)
    s, t = (hnsw.Shard(2, np.array(ids).tobytes(), np.ones((3, 2)).tobytes(), np.array(n).tobytes()) for ids, n in (([1, 2, 3], [1, 1, 5]), ([10, 20, 30], [2, 1, 1])))
    chunks = [(np.array([0, 0, 2]), np.array([0, 1, 2])), (np.array([0, 1]), np.array([1, 1]))]
    found = [tuple(r) for pdf in hnsw.merged_links(s, t, iter(chunks), 3) for r in pdf.itertuples(index=False)]
    assert sorted(r for r in found if r[2] == 0) == [(1, 10, 0), (1, 20, 0), (2, 20, 0)]
    assert {a: n for a, _, n in found if n} == {1: 3, 2: 1, 3: 1, 10: 1, 20: 2, 30: 5}
    assert {a: b for a, b, n in found if n} == {1: 1, 2: 1, 10: 1, 20: 1, 3: 3, 30: 3}


def test_wide_beams_find_what_single_steps_find(monkeypatch):
    rng = np.random.default_rng(10)
    base = np.concatenate([rng.normal(size=(1500, 24)), rng.normal(size=24) + rng.normal(scale=0.1, size=(500, 24))]).astype(np.float32)
    base /= np.linalg.norm(base, axis=1)[:, None]
    graph = hnsw.Graph(base).build()
    ids, sims = graph.search(base[::20], 256)
    assert all(len(set(row)) == 256 for row in ids)  # no node twice
    monkeypatch.setattr(hnsw, "BEAM_STEP", 1 << 20)
    _, single = graph.search(base[::20], 256)
    assert (sims >= 0.9).sum(1).tolist() == (single >= 0.9).sum(1).tolist()
