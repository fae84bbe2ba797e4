"""Packing, prefix trie and whitening against plain versions."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyfold.llm import packing, scans, trie, whitening
from tallyfold.runtime import stage

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(VOCABULARY)
    found.encode_special_tokens = True
    return found


@pytest.fixture(scope="module")
def encoder():
    with open(VOCABULARY, encoding="utf-8") as file:
        return packing.Encoder(file.read())


SPACES = ["a  b", " \n b", "\t\t x", "é  à ", "x  y", "　 z", "a  b  ", "don't  'll 's", "<|endoftext|> x <|endoftext|>", "名前 は", "1 2  3", "a\x1c b", "a\x85 b", "🙂 🙂", "", " "]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t 　\x85ab1'.é名🙂", max_size=30) | st.sampled_from(SPACES), min_size=1, max_size=6))
def test_ids_are_those_of_the_library(tokenizer, encoder, texts):
    texts = [*texts, " ".join(texts)]
    ids, n = encoder.encode(texts)
    whole = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == list(map(len, whole)) and ids.tolist() == [i for w in whole for i in w]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*SPACES, "don't", "I'll", "x's", "naïve Wörter", "“quoted” — dash…", "Straße 12", "слово", "λόγος", "\n\n", "    ", "a" * 300, " " * 70, "!?!?", "e.g.,"]), max_size=30), st.integers(3, 40))
def test_slices_have_the_ids_of_the_text(tokenizer, encoder, words, limit):
    text = "".join(words)
    cut = packing.slices(text, limit)
    assert "".join(cut) == text
    ids = [i for one in cut for i in encoder.encode([one])[0].tolist()]
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_long_runs_and_plain_texts(tokenizer, encoder):
    texts = ["x" * 100_000, " " * 100_000, "ab cd " * 50_000, "word " * 10 + "y" * 400 + " word", "\n" * 3000 + "a"]
    for text in texts:
        assert encoder.encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert [packing.plain(t) for t in texts] == [False, False, True, False, False]
    assert len(packing.slices(texts[2])) == 2 and len(packing.slices(texts[1])) == 1


def test_pieces_cover_every_document(spark, tokenizer):
    long_text = " ".join(f"w{i}é" for i in range(9000))
    texts = [None, "", "one", long_text, "x" * 5000, "a b " * 700, "same", "same", *SPACES]
    rows = [(i, t, "extra", 3) for i, t in enumerate(texts)] + [(None, "no id", "e", 1), (7, "same", "e", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, task int").repartition(3)
    got = packing.pack(docs, VOCABULARY).toPandas()
    assert sorted(got["sequence_id"]) == list(range(len(got))) and (got["offset"] == 0).all()
    assert got.sort_values("sequence_id")["length"].is_monotonic_decreasing
    assert all(n & (n - 1) == 0 and n <= 1024 for n in got["length"])
    expected = defaultdict(list)
    for i, t, *_ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for b in [1024] * (len(ids) // 1024) + [1 << k for k in range(9, -1, -1) if len(ids) % 1024 >> k & 1]:
            expected[-1 if i is None else i].append((at, b, len(ids), ids[at : at + b].tobytes()))
            at += b
    made = defaultdict(list)
    for r in got.itertuples():
        made[-1 if r.doc_id != r.doc_id else int(r.doc_id)].append((r.start, r.length, r.doc_tokens, bytes(r.tokens)))
    assert {k: sorted(v) for k, v in made.items()} == {k: sorted(v) for k, v in expected.items()}
    assert packing.pack(docs.limit(0), VOCABULARY).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, VOCABULARY, longest=1000)


def plain_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}|{role}{text}".encode()).hexdigest()[:30]
            turns[c].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    leaves, saved, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, who in members.items():
        own = (len(who) - 1) * len(node[-1][1].split()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += node not in children
    return sorted(
        (min(who), len(node), min(members[node[:-1]]) if node else None, len(who), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, who in members.items()
    )


def made_conversations():
    rng = np.random.default_rng(5)
    rows = []
    for c in [*range(70), 85, 86, 400, 401, 2**40]:
        for t in range(int(rng.integers(0, 7))):
            rows.append((c, t if rng.random() < 0.9 else None, str(rng.choice(["user", "system"])), f"say {rng.integers(0, 2)} now"))
    rows += [(500, t, "user", f"turn {t % 3}") for t in range(300)]  # one conversation holds most of the rows
    rows += [(c, 0, "user", "a very common turn") for c in range(600, 700)]
    rows += [(c, t, "user", f"copy {t}") for c in range(720, 760) for t in range(5)]
    rows += [(70, 1, None, None), (70, 1, "", ""), (71, 2, "user", "tie b"), (71, 2, "user", "tie a"), (71, 2, "user", "tie a"), (None, 1, "user", "lost")]
    return rows


@pytest.mark.parametrize("limit", [1 << 17, 40, 3])
def test_trie_equals_the_plain_one(spark, limit):
    rows = made_conversations()
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, p1 string")
    got = trie.prefix_trie(frame.repartition(5), shard_rows=limit).collect()
    assert sorted(tuple(r) for r in got) == plain_trie(rows)
    if limit == 3:
        assert trie.prefix_trie(frame.limit(0)).count() == 0


def test_scan_of_a_group_over_many_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), i, int(rng.integers(-(2**62), 2**62))) for i, g in enumerate(np.where(rng.random(3000) < 0.9, 7, rng.integers(0, 12, 3000)))]
    df = stage(spark.createDataFrame(rows, "g long, i long, v long").repartition(6))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = scans.group_scan(df, "g", ["i"], "v", "i").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    seen = {}
    expected = []
    for g, i, v in rows:
        n, a, b = seen.get(g, (0, 0, 0))
        seen[g] = (n + 1, a ^ v, b ^ i)
        expected.append((g, i, v, *seen[g]))
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_perfect_hash_and_two_prefixes_of_one_digest():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, (2, 5000)).astype(np.uint64)
    table = trie.PerfectHash(a, b)
    assert sorted(table.slots(a, b)) == list(range(5000))
    with pytest.raises(RuntimeError):
        trie.PerfectHash(np.repeat(a[:2], 2), np.repeat(b[:2], 2))


def plain_whitening(vectors, k=16):
    kept = [v for v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(64 * np.array(kept, float)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    z = u - s / n
    values, q = np.linalg.eigh(z.T @ z / n)
    values, q = values[::-1], q[:, ::-1]
    return n, [int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s))) for row in x], ((x - s / n) @ q[:, :k]) / np.sqrt(np.maximum(values[:k], 1e-300)), values[:k] / values.sum()


@pytest.mark.parametrize("scale", [1.0, 1e5])
def test_whitening_equals_eigenvectors(spark, scale):
    rng = np.random.default_rng(2)
    vectors = [v.tolist() for v in rng.normal(size=(400, 20)) * np.geomspace(scale, 0.3, 20) + 5]
    vectors += vectors[:30] + [None, [None] * 20, [float("nan")] * 20, [float("inf")] + [0.0] * 19]
    rows = [(i, v, i % 3, "x") for i, v in enumerate(vectors)] + [(None, vectors[0], 1, "y")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, dim int, x string").repartition(3)
    got = whitening.whitened(frame).toPandas()
    n, deviation, expected, explained = plain_whitening([r[1] for r in rows])
    assert len(got) == 431 * 16 and (got["n"] == n).all() and got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-9
    named = got[got["vec_id"].notna()].sort_values(["vec_id", "component"])
    w = named["whitened"].to_numpy().reshape(-1, 16)
    signs = np.sign((w * expected[:-1]).sum(axis=0))
    assert np.abs(w - expected[:-1] * signs).max() < 1e-6
    exact = {r[0]: r[1] for r in whitening.whitened(frame).where("component = 3").select("vec_id", "deviation").collect()}
    kept = [*range(430), None]
    assert [exact[i] for i in kept] == [v if v < 2**63 else None for v in deviation]
    assert np.allclose(named["explained"].to_numpy().reshape(-1, 16)[0], explained, rtol=1e-9)


def test_whitening_of_odd_tables(spark):
    schema = "vec_id string, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema)).count() == 0
    same = [("a", [1.0, 2.0]), ("b", [1.0, 2.0]), (None, None), ("c", [])]
    assert whitening.whitened(spark.createDataFrame(same, schema)).count() == 0
    # A plane in three dimensions has two components; vectors of another length are a space of their own.
    rows = [(str(i), [float(a), float(b), float(a + b)]) for i, (a, b) in enumerate([(0, 0), (1, 0), (0, 1), (1, 1), (3, 2)])]
    rows += [("p", [0.0]), ("q", [1.0]), ("huge", [1e30])]
    got = whitening.whitened(spark.createDataFrame(rows, schema)).toPandas()
    assert got.groupby("vec_id").size().to_dict() == {**{str(i): 2 for i in range(5)}, "p": 1, "q": 1}
    assert np.allclose(got[got["vec_id"] == "q"]["whitened"].abs(), 1.0) and got["identity_error"].max() < 1e-12


def test_deviation_that_fits_no_long():
    assert whitening.deviations(np.array([[0, 0], [2**40, 4]], np.int64), 2, [2**40, 4]) == [None, None]
    assert whitening.deviations(np.array([[1, 3]], np.int64), 4, [2, 2]) == [4 + 100]


def test_jacobi_keeps_small_eigenvalues():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.normal(size=(9, 9)))
    d = np.diag(np.geomspace(1e8, 1e-3, 9))
    values, vectors = whitening.one_sided_jacobi(whitening.pivoted_cholesky(q @ d @ q.T))
    assert np.allclose(vectors.T @ vectors, np.eye(9), atol=1e-12) and np.allclose(values[:7], np.diag(d)[:7], rtol=1e-6)
