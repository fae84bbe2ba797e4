"""Trained operators: held-out accuracy, exact parts against plain versions, and odd input."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_words import plain_words

from tallyfold.llm import gru, langid, quality, toxicity
from tallyfold.llm.parts import fold, read

SF = "/root/testdata/sf0.01"
ODD = [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "x" * 300_000), (9005, "!!! 123"), (None, "the and of"), (9006, "a"), (9006, "a")]


def odd_docs(spark, lang="en"):
    return spark.createDataFrame([(i, t, lang, 0.5, "q") for i, t in ODD], "doc_id long, text string, lang string, score double, _text string")


def crc(i):
    return zlib.crc32(str(i).encode())


def auc(y, p):
    y, p = np.asarray(y), np.asarray(p)
    return np.mean([(p[y == 1][:, None] > p[y == 0][None]).mean() + 0.5 * (p[y == 1][:, None] == p[y == 0][None]).mean()])


def test_fold_is_crc32(spark):
    got = {r[0]: r[1] for r in spark.range(50).select("id", fold("id", 5)).collect()}
    assert got == {i: crc(i) % 5 for i in range(50)}


def test_language_held_out(spark):
    docs = read(spark, SF, "documents")
    model = langid.train(docs, fold("doc_id", 3) != 1)
    got = langid.predict(docs.unionByName(odd_docs(spark).select("doc_id", "text", "lang"), allowMissingColumns=True), model, ["doc_id", "lang"]).toPandas()
    held = got[got["doc_id"].lt(9000) & got["doc_id"].map(lambda i: crc(int(i)) % 3 == 1 if i == i else False)]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.98
    odd = got[got["doc_id"] > 9000].set_index("doc_id")["lang_pred"]
    assert odd[9001] == odd[9002] == odd[9003] == odd[9005] == "und" and odd[9004] in model[0]
    assert got["score"].between(0, 1).all()


def test_language_without_training(spark):
    model = langid.train(odd_docs(spark), F.lit(False))
    got = langid.predict(odd_docs(spark), model, ["doc_id"]).toPandas()
    assert set(got["lang_pred"]) == {"und"} and set(got["score"]) == {0.0}


def test_language_counts_are_exact():
    """One text, by hand: letters a, b; pairs with a letter in the middle; triples."""
    import pyarrow as pa

    from tallyfold.llm.words import text_slices

    _, _, data, offsets = next(text_slices(pa.array(["Ab a"])))
    c, first = langid.letters(data, offsets)
    sizes = [len(b) for b, _ in langid.ngram_buckets(c, first)]
    assert sizes == [3, 2, 1]  # a b a; ab, b_; Ab_ (the middle of _a is no letter)


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_labels_of_one_class_or_none(spark, module, label):
    docs = odd_docs(spark)
    for rows, expected in (([], 0.5), ([(9006, 1), (9005, 1), (9004, None)], 1.0)):
        labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
        model = module.train(docs, labels, F.lit(True))
        got = module.score(docs.drop("score"), model, ["doc_id"]).toPandas()
        assert got["score"].to_numpy() == pytest.approx(expected, abs=0.01) and len(got) == len(ODD)
    assert module.score(docs.limit(0).drop("score"), model, ["doc_id"]).count() == 0


def test_quality_held_out(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    model = quality.train(docs, labels, fold("doc_id", 5) != 0)
    got = quality.score(docs.select("doc_id", "text"), model, ["doc_id"]).join(labels, "doc_id").toPandas()
    held = got[got["doc_id"].map(lambda i: crc(i) % 5 == 0)]
    assert auc(held["quality"], held["score"]) > 0.97
    assert ((held["score"] >= 0.3) == held["quality"]).mean() > 0.9
    again = quality.score(odd_docs(spark), model, ["doc_id"], out="s").toPandas()
    assert again["s"].between(0, 1).all() and len(again) == len(ODD)


def test_dual_descent_separates():
    rng = np.random.default_rng(0)
    rows = [np.unique(np.append(rng.integers(10, 200, 12), i % 2)) for i in range(200)]
    y = np.where(np.arange(200) % 2 == 0, 1.0, -1.0)
    w, b = quality.dual_descent(rows, y, np.ones(200), np.full(200, 10.0), 60)
    margin = np.array([w[r].sum() / np.sqrt(len(r)) + b for r in rows])
    assert (margin * y > 0).mean() > 0.98


def toxic_docs(spark, n=900):
    rng = random.Random(1)
    words = {"en": "the of and house tree walk stone river".split(), "de": "der die und haus baum weg stein fluss".split()}
    bad = {"en": ["dolt", "oaf"], "de": ["depp", "dussel"]}
    rows = []
    for i in range(n):
        lang, toxic = ("en", "de")[i % 2], int(rng.random() < 0.2)
        text = rng.choices(words[lang], k=rng.randint(5, 60))
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(bad[lang]))
        rows.append((i, " ".join(text), lang, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")


def test_toxicity_held_out(spark):
    docs = toxic_docs(spark)
    model = toxicity.train(docs, docs.select("doc_id", "toxic"), fold("doc_id", 5) != 0)
    got = toxicity.score(docs, model, ["doc_id", "toxic"]).toPandas()
    held = got[got["doc_id"].map(lambda i: crc(i) % 5 == 0)]
    assert ((held["score"] >= 0.5) == held["toxic"]).mean() > 0.97
    odd = toxicity.score(odd_docs(spark).drop("score"), model, ["doc_id"]).toPandas()
    assert odd["score"].between(0, 1).all()
    assert len(model.threshold) == 2


def test_thresholds_come_from_all_rows_apart(spark):
    """A rare language gets its own cut, and languages their words, from labelled rows far beyond the fit sample."""
    docs = toxic_docs(spark, 3000).withColumn("lang", F.when(F.col("lang") == "de", F.when(F.col("doc_id") % 20 == 1, "de")).otherwise("en"))
    labels = docs.select("doc_id", "toxic")
    model = toxicity.train(docs, labels, F.lit(True), max_fit_rows=40)
    seen = docs.where("lang IS NOT NULL").groupBy("lang").count().toPandas().set_index("lang")["count"] + 1
    assert np.allclose(np.exp(model.lang_logp[-1]), (seen / seen.sum()).sort_index(), atol=1e-5)
    apart = docs.where(F.pmod(F.xxhash64(F.lit(9), F.col("doc_id").cast("string")), F.lit(toxicity.CALIBRATION)) == 0)
    bins = toxicity.logit_bins(apart.select("text", "toxic"), model)
    assert sum(bins["n0"].to_pylist()) + sum(bins["n1"].to_pylist()) == apart.count()
    assert all(sum(n for k, n in zip(bins["k"].to_pylist(), bins["n1"].to_pylist()) if k == j) >= toxicity.MIN_TOXIC for j in (0, 1))
    assert model.threshold[0] != model.threshold[1]


def test_thresholds_of_bins():
    low, high, n0, n1 = [0.0, 1.0, 2.0], [0.5, 1.5, 2.5], [5, 4, 0], [0, 1, 9]
    bins = toxicity.pa.table([[0, 0, 0], [0, 1, 2], n0, n1, low, high], ["k", "bin", "n0", "n1", "low", "high"])
    model = toxicity.Model(None, [], [], None, 0.0, ["en", "de"])
    assert toxicity.fit_thresholds(model, bins).tolist() == [1.75, 1.75]


def test_best_threshold():
    score, y = np.array([3.0, 2.0, 1.0, 0.0]), np.array([1, 1, 0, 0])
    assert 1.0 < toxicity.best_threshold(score, y, np.ones(4)) < 2.0
    assert toxicity.best_threshold(score, np.zeros(4), np.ones(4)) > 3.0


def small_model(k=20, seed=0):
    rng = np.random.default_rng(seed)
    model = gru.new_model(np.sort(rng.integers(1, 2**63, k).astype(np.uint64)), np.arange(k, 0, -1).astype(float) * 5, np.full(gru.TAIL_CLASSES, 3.0))
    for key in ("wc", "ww"):
        model[key] = rng.normal(0, 0.5, model[key].shape).astype(np.float32)
    return model


def plain_score(model, ids):
    """One document, one step at a time, in double precision."""
    m = {k: v.astype(np.float64) if isinstance(v, np.ndarray) and v.dtype == np.float32 else v for k, v in model.items()}
    k, per, hid = len(m["rank"]), m["per"], gru.HIDDEN
    h, before, total = np.zeros(hid), len(m["wx"]) - 1, 0.0
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    soft = lambda x, i: x[i] - np.log(np.exp(x).sum())
    for w in ids:
        x, a = m["wx"][before], h @ m["u"]
        z, r = sigmoid(x[:hid] + a[:hid]), sigmoid(x[hid : 2 * hid] + a[hid : 2 * hid])
        h = (1 - z) * np.tanh(x[2 * hid :] + r * a[2 * hid :]) + z * h
        cls = w // per if w < k else gru.CLASSES + w - k
        total += soft(h @ m["wc"] + m["bc"], cls)
        if w < k:
            span = slice(w // per * per, min((w // per + 1) * per, k))
            total += soft(m["ww"][span] @ h + m["bw"][span], w - span.start)
        before = w
    return total


def test_states_are_carried_across_windows():
    model, rng = small_model(), np.random.default_rng(1)
    sizes = [1, 3, 0, 500, 129, 128, 2]
    ids = rng.integers(0, 20 + gru.TAIL_CLASSES, sum(sizes)).astype(np.int32)
    first = np.cumsum([0, *sizes])
    got = gru.score_tokens(model, ids, first)
    expected = [plain_score(model, ids[a:b]) for a, b in zip(first[:-1], first[1:])]
    assert got == pytest.approx(expected, rel=2e-4, abs=1e-6)
    assert np.exp(gru.log_probs(model, np.zeros((1, gru.HIDDEN), np.float32), np.array([3]))) < 1


def test_training_lowers_the_loss():
    model, rng = small_model(), np.random.default_rng(2)
    ids = np.tile(np.array([1, 5, 2, 9, 0], np.int32), 800)
    first = np.arange(0, len(ids) + 1, 50)
    learner = gru.Learner(model)
    losses = [learner.fit(ids, first) / len(ids) for _ in range(12)]
    assert losses[-1] < 0.4 * losses[0] and rng is not None


def test_probabilities_add_up():
    """Over all head words and tail classes, the chances at one state are one."""
    model = small_model()
    n = 20 + gru.TAIL_CLASSES
    states = np.repeat(np.random.default_rng(3).normal(size=(1, gru.HIDDEN)).astype(np.float32).clip(-1, 1), n, 0)
    assert np.exp(gru.log_probs(model, states, np.arange(n))).sum() == pytest.approx(1, abs=1e-4)


def test_language_model_base_and_held_out(spark, monkeypatch):
    monkeypatch.setattr(gru, "KNOWN", 500)
    monkeypatch.setattr(gru, "VOCABULARY", 300)
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").unionByName(odd_docs(spark).where("doc_id <> 9004").select("doc_id", "text"))
    got = gru.score_documents(docs.where("doc_id IS NOT NULL"), fold("doc_id", 5) != 1).toPandas()
    rows = [(r["doc_id"], [*plain_words(r["text"]), None]) for r in docs.where("doc_id IS NOT NULL").collect()]
    counts = collections.Counter(w for i, ws in rows if crc(i) % 5 != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    assert set(got["train_tokens"]) == {n} and len(got) == len(rows)
    got = got.drop_duplicates("doc_id").set_index("doc_id")
    for i, ws in rows:
        assert got.loc[i, "n_tokens"] == len(ws) and got.loc[i, "n_known"] == sum(counts[w] > 0 for w in ws)
        assert got.loc[i, "base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
    held = got[[crc(i) % 5 == 1 for i in got.index]]
    assert held["score"].sum() > held["base_score"].sum() and (got["score"] < 0).all()


def test_language_model_without_training(spark):
    docs = odd_docs(spark).where("doc_id IS NULL OR doc_id <> 9004")
    got = gru.score_documents(docs, F.lit(False)).toPandas()
    assert len(got) == len(ODD) - 1 and set(got["n_known"]) == {0} and np.isfinite(got["score"]).all()


def test_learners_are_averaged_in_groups(spark, monkeypatch):
    """The average does not depend on how many weights are merged at a time, and no document is left out."""
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").repartition(5, "doc_id")
    head = np.sort(np.random.default_rng(0).integers(1, 2**63, 8).astype(np.uint64))
    model = gru.new_model(head, np.arange(8, 0, -1).astype(float), np.full(gru.TAIL_CLASSES, 9.0))
    monkeypatch.setattr(gru, "WARM_TOKENS", 3_000)
    found = []
    for most in (2, 64):
        monkeypatch.setattr(gru, "MERGE", most)
        found.append(gru.train(docs, F.lit(True), model))
    for k in gru.TRAINED:
        assert found[0][k] == pytest.approx(found[1][k], abs=1e-5)
        assert np.isfinite(found[0][k]).all()


def test_windows_and_classes_are_laid_out_at_once():
    """All steps of a window come in one array, words of a class in one slice; what that gives equals a product per token."""
    length, offset = np.array([5, 3, 3, 1]), np.array([0, 5, 8, 11])
    starts, places = gru._window(offset, length, 1, 4)
    assert starts.tolist() == [0, 3, 6, 7] and places.tolist() == [1, 6, 9, 2, 7, 10, 3]
    cls = np.array([40, 3, 0, 33, 3, 31, 0])
    rows, ends = gru._by_class(cls)
    assert rows.tolist() == [2, 6, 1, 4, 5] and ends[[0, 1, 4, gru.CLASSES]].tolist() == [0, 2, 4, 5]
    logits = np.random.default_rng(0).normal(size=(6, 9)).astype(np.float32) * 3
    pick = np.array([0, 8, 3, 3, 1, 2])
    p = np.exp(logits.astype(float))
    p /= p.sum(1, keepdims=True)
    for safe in (True, False):
        error, loss = gru._error(logits.copy(), pick, np.float32(0.5), safe)
        assert np.allclose(error, 0.5 * (p - np.eye(9)[pick]), atol=1e-6) and loss == pytest.approx(-np.log(p[np.arange(6), pick]).sum(), rel=1e-5)


def test_few_words_of_a_table_share_their_first_bits():
    """A word is looked for among the few that share its first bits, whether it is there or not."""
    rng = np.random.default_rng(4)
    table = np.unique(rng.integers(0, 2**64, 5_000, np.uint64))
    starts = gru.prefix_starts(table)
    assert np.diff(starts).max() <= 8 and starts[-1] == len(table)
    asked = np.concatenate([table[::3], rng.integers(0, 2**64, 3_000, np.uint64), np.array([0, 2**64 - 1], np.uint64)])
    places = {int(h): i for i, h in enumerate(table)}
    for some in (table, table[:1], table[:0]):
        expected = [i if i < len(some) else -1 for i in (places.get(int(h), -1) for h in asked)]
        assert gru.lookup(some, asked).tolist() == expected
