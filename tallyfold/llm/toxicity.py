"""Toxicity: a convolutional text classifier with hashed word embeddings, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.fitting import bounded_sample
from tallyfold.llm.parts import with_small
from tallyfold.llm.words import NOT_ALNUM, release, segment_sum, split_words, text_slices

BITS = 16  # embedding rows; every word uses two of them
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8  # per width
EPOCHS = 6
BATCH = 32
RATE = 0.05
# One labelled row in so many is kept for the thresholds alone: neither counted nor trained on.
CALIBRATION = 5
# Rows the network is fitted on; class counts, language words and thresholds come from all labelled rows.
MAX_FIT_ROWS = 8_000
# A language with fewer toxic rows than this among all rows set apart shares the threshold of all languages.
MIN_TOXIC = 12
# Bins of the logits' inverse hyperbolic sine, per unit: 1/2048 of a logit near 0, a constant share of large ones.
BINS = 2_048
# Languages a counting task holds before it hands its counts on.
LANGS_HELD = 32


def word_buckets(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two embedding rows per word, lower-cased and cut at punctuation, and the first word of each document."""
    words = split_words(data, offsets, fold=True, separators=NOT_ALNUM)
    mask = np.uint64((1 << bits) - 1)
    return (words.hash & mask).astype(np.int32), ((words.hash >> np.uint64(32)) & mask).astype(np.int32), words.first


@dataclass
class Model:
    table: np.ndarray  # embeddings
    filters: list[np.ndarray]  # per width: width x DIM x FILTERS
    shift: list[np.ndarray]
    out: np.ndarray
    bias: float
    langs: list[str] = field(default_factory=list)
    lang_logp: np.ndarray | None = None  # buckets x languages, the last row holds priors
    threshold: np.ndarray | None = None  # per language, in logits; without languages one


def _windows(x: np.ndarray, first: np.ndarray, model: Model) -> list[np.ndarray]:
    """Filter responses of the window that starts at each word; beyond the document's end there are zeros."""
    n = len(x)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)  # words from here to the end
    out = []
    for w, b in zip(model.filters, model.shift):
        z = x @ w[0] + b
        for j in range(1, len(w)):
            part = x[j:] @ w[j]
            part[left[: n - j] <= j] = 0
            z[: n - j] += part
        out.append(z)
    return out


def _features(z: list[np.ndarray], first: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each document, at least 0."""
    docs = len(first) - 1
    full = np.flatnonzero(np.diff(first) > 0)
    out = np.zeros((docs, len(z) * z[0].shape[1]), np.float32)
    if len(full):
        for k, part in enumerate(z):
            width = part.shape[1]
            out[full, k * width : (k + 1) * width] = np.maximum.reduceat(part, first[full], axis=0)
    return np.maximum(out, 0)


def logits(model: Model, a: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
    x = model.table[a] + model.table[b]
    return _features(_windows(x, first, model), first) @ model.out + model.bias


def language(model: Model, a: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index of the likeliest language of each document by its words."""
    scores = np.stack([segment_sum(model.lang_logp[a, k], first) for k in range(len(model.langs))], 1) + model.lang_logp[-1]
    return scores.argmax(1)


def fit_network(docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, ratio: np.ndarray, seed: int = 7) -> Model:
    """Adagrad on the logistic loss. The first embedding dimension starts from the class log-count ratio of its row."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.05, (len(ratio), DIM)).astype(np.float32)
    table[:, 0] += (ratio / 2).astype(np.float32)
    filters = [rng.normal(0, 0.15, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for w in filters:
        w[0, 0, : FILTERS // 2] = np.abs(w[0, 0, : FILTERS // 2]) + 0.5
    model = Model(table, filters, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32), 0.0)
    model.out[::FILTERS] = 0.5
    past = {"table": np.full(len(table), 1e-3, np.float32), "out": np.full(len(model.out), 1e-3), "bias": 1e-3}
    past_w = [np.full(w.shape, 1e-3) for w in filters]
    past_b = [np.full(FILTERS, 1e-3) for _ in WIDTHS]
    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), BATCH):
            rows = [i for i in order[lo : lo + BATCH] if len(docs[i][0])]
            if not rows:
                continue
            a, b = (np.concatenate([docs[i][k] for i in rows]) for k in (0, 1))
            first = np.cumsum([0, *(len(docs[i][0]) for i in rows)])
            x = model.table[a] + model.table[b]
            z = _windows(x, first, model)
            feats = _features(z, first)
            p = 1 / (1 + np.exp(-np.clip(feats @ model.out + model.bias, -30, 30)))
            d = ((p - y[rows]) / len(rows)).astype(np.float32)
            d_feat = np.outer(d, model.out) * (feats > 0)
            d_out, d_bias = feats.T @ d, float(d.sum())
            d_x = np.zeros_like(x)
            for k, (w, part) in enumerate(zip(model.filters, z)):
                g = d_feat[:, k * FILTERS : (k + 1) * FILTERS]
                at = np.stack([first[i] + part[first[i] : first[i + 1]].argmax(0) for i in range(len(rows))])
                d_w = np.zeros_like(w)
                for j in range(len(w)):
                    here = at + j
                    inside = here < first[1:, None]
                    gj = g * inside
                    here = np.minimum(here, len(x) - 1)
                    d_w[j] = np.einsum("dfe,df->ef", x[here], gj)
                    np.add.at(d_x, here, gj[:, :, None] * w[j].T[None])
                past_w[k] += d_w**2
                past_b[k] += g.sum(0) ** 2
                w -= (RATE * d_w / np.sqrt(past_w[k])).astype(np.float32)
                model.shift[k] -= (RATE * g.sum(0) / np.sqrt(past_b[k])).astype(np.float32)
            past["out"] += d_out**2
            past["bias"] += d_bias**2
            model.out -= (RATE * d_out / np.sqrt(past["out"])).astype(np.float32)
            model.bias -= RATE * d_bias / np.sqrt(past["bias"])
            moved = np.flatnonzero(np.abs(d_x).any(1))
            for rows_of in (a[moved], b[moved]):
                np.add.at(past["table"], rows_of, (d_x[moved] ** 2).mean(1))
                np.add.at(model.table, rows_of, -RATE * d_x[moved] / np.sqrt(past["table"][rows_of])[:, None])
    return model


def best_threshold(score: np.ndarray, y: np.ndarray, weight: np.ndarray, high: np.ndarray | None = None) -> float:
    """The cut with the highest F1, in the middle of the gap below it; without toxic rows above all scores.

    A row can stand for ``weight`` rows with scores from ``score`` to ``high``; such ranges are equal or do not overlap.
    """
    order = np.argsort(-score, kind="stable")
    s, hit, w = score[order], y[order] == 1, weight[order]
    top = s if high is None else high[order]
    tp, fp = np.cumsum(w * hit), np.cumsum(w * ~hit)
    if not len(s) or tp[-1] == 0:
        return float(top[0]) + 1.0 if len(s) else 0.0
    f1 = 2 * tp / (tp + fp + tp[-1])
    f1[:-1][s[1:] == s[:-1]] = -1  # not between equal scores
    k = int(f1.argmax())
    return float((s[k] + top[k + 1]) / 2) if k + 1 < len(s) else float(s[k]) - 1e-6


def logit_bins(rows: DataFrame, model: Model, bits: int = BITS) -> pa.Table:
    """(k, y, n, low, high) per language predicted from the words, class and bin of logits, of rows of (text, class).

    One row per bin that is not empty reaches the driver, whatever the number of rows; low and high are the bin's for both classes.
    """
    shared = rows.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Model(**shared.value)
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for row, end, data, offsets in text_slices(batch.column(0)):
                a, b, first = word_buckets(data, offsets, bits)
                raw = logits(net, a, b, first).astype(np.float64)
                k = language(net, a, first) if net.langs else np.zeros(len(raw), np.int64)
                bin_ = np.floor(np.arcsinh(raw) * BINS).astype(np.int64)
                columns = [pa.array(c) for c in (k, bin_, (y[row:end] == 0).astype(np.int64), (y[row:end] == 1).astype(np.int64), raw)]
                part = pa.table(columns, ["k", "bin", "n0", "n1", "raw"]).group_by(["k", "bin"])
                part = part.aggregate([("n0", "sum"), ("n1", "sum"), ("raw", "min"), ("raw", "max")])
                yield from part.select(["k", "bin", "n0_sum", "n1_sum", "raw_min", "raw_max"]).rename_columns(["k", "bin", "n0", "n1", "low", "high"]).to_batches()

    bins = rows.mapInArrow(run, "k long, bin long, n0 long, n1 long, low double, high double").groupBy("k", "bin")
    return bins.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.min("low").alias("low"), F.max("high").alias("high")).toArrow()


def fit_thresholds(model: Model, bins: pa.Table) -> np.ndarray:
    """The best cut of each language with MIN_TOXIC toxic rows at least, for the others that of all languages together."""
    k, bin_, n0, n1, low, high = (bins[c].to_numpy() for c in ("k", "bin", "n0", "n1", "low", "high"))
    _, at = np.unique(bin_, return_inverse=True)
    least, most = np.full(at.max(initial=-1) + 1, np.inf), np.full(at.max(initial=-1) + 1, -np.inf)
    np.minimum.at(least, at, low)
    np.maximum.at(most, at, high)
    y, weight = np.repeat([0, 1], len(k)), np.concatenate([n0, n1])
    out = np.full(max(1, len(model.langs)), best_threshold(np.tile(least[at], 2), y, weight, np.tile(most[at], 2)))
    for j in range(len(model.langs)):
        if n1[k == j].sum() >= MIN_TOXIC:
            mine = np.tile(k == j, 2)
            out[j] = best_threshold(np.tile(low, 2)[mine], y[mine], weight[mine], np.tile(high, 2)[mine])
    return out


def train(docs: DataFrame, labels: DataFrame, use: Column, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", max_fit_rows: int = MAX_FIT_ROWS, bits: int = BITS) -> Model:
    """Fit on the labelled rows where ``use`` holds; the language column only tells which words belong to which language.

    One row in CALIBRATION is set apart. Class counts of every embedding row come from all the others, the words of each
    language from all labelled rows; the network is fitted on at most ``max_fit_rows`` rows, and the thresholds on all rows
    that are set apart: one per language predicted from the words, so that no column but the text takes part in a score.
    Rows without a label are left out; without both classes, scores are constant.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(id_col).agg(F.max(label).cast("int").alias("_y"))
    rows = with_small(docs.where(use).select(id_col, text_col, lang_col), known, [id_col])
    apart = F.pmod(F.xxhash64(F.lit(9), F.col(id_col).cast("string")), F.lit(CALIBRATION)) == 0
    rows = rows.select(id_col, text_col, lang_col, "_y", apart.alias("apart"))
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Class counts (of rows not apart) and words per language (all rows; bucket ``size`` counts documents)."""
        names = ["spoken", "lang", "bucket", "n0", "n1"]
        sums, words = np.zeros((2, size), np.int64), {}

        def spoken() -> Iterator[pa.RecordBatch]:
            for name, n in words.items():
                at = np.flatnonzero(n)
                yield pa.record_batch([pa.array(np.ones(len(at), bool)), pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(n[at]), pa.array(np.zeros(len(at), np.int64))], names)
            words.clear()

        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            y[batch.column(3).to_numpy(zero_copy_only=False).astype(bool)] = -1
            for row, end, data, offsets in text_slices(batch.column(0)):
                a, b, first = word_buckets(data, offsets, bits)
                doc = np.repeat(np.arange(end - row), np.diff(first))
                seen = np.unique(np.concatenate([doc << bits | a, doc << bits | b]))
                of = y[row:end][seen >> bits]
                for c in (0, 1):
                    sums[c] += np.bincount(seen[of == c] & (size - 1), minlength=size)
                coded = batch.column(2).slice(row, end - row).dictionary_encode()
                which = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
                for k, name in enumerate(coded.dictionary.to_pylist()):
                    if len(words) >= LANGS_HELD and name not in words:
                        yield from spoken()
                    n = words.setdefault(name, np.zeros(size + 1, np.int64))
                    n[:size] += np.bincount(a[which[doc] == k], minlength=size)
                    n[size] += int((which == k).sum())
        yield from spoken()
        at = np.flatnonzero(sums.any(0))
        yield pa.record_batch([pa.array(np.zeros(len(at), bool)), pa.nulls(len(at), pa.string()), pa.array(at), pa.array(sums[0][at]), pa.array(sums[1][at])], names)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column(0)):
                a, b, first = word_buckets(data, offsets, bits)
                lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(v, pa.int32())) for v in (a, b)]
                part = batch.slice(row, end - row)
                yield pa.record_batch([*part.columns[1:], *lists], ["y", "h", "a", "b"])

    table = rows.select(text_col, "_y", F.col(lang_col).cast("string"), "apart").mapInArrow(count, "spoken boolean, lang string, bucket long, n0 long, n1 long")
    table = table.groupBy("spoken", "lang", "bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow().combine_chunks()
    spoken = table["spoken"].to_numpy(zero_copy_only=False).astype(bool)
    at, n0, n1 = (table[c].to_numpy() for c in ("bucket", "n0", "n1"))
    n = np.zeros((2, size))
    n[0, at[~spoken]], n[1, at[~spoken]] = n0[~spoken], n1[~spoken]
    sample, sizes = bounded_sample(rows, "_y", id_col, max_fit_rows)
    if len(sizes) < 2:
        flat = -10.0 if sizes.get(0) else 10.0 if sizes else 0.0
        zero = [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS]
        return Model(np.zeros((size, DIM), np.float32), zero, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.zeros(FILTERS * len(WIDTHS), np.float32), flat, threshold=np.zeros(1))
    ratio = np.log((n[1] + 0.5) / (sizes[1] + 1)) - np.log((n[0] + 0.5) / (sizes[0] + 1))
    h = F.xxhash64(F.lit(5), F.col(id_col).cast("string"))
    fit = sample.where("NOT apart").select(text_col, "_y", h.alias("h")).mapInArrow(features, "y int, h long, a array<int>, b array<int>")
    fit = fit.toArrow().sort_by("h").combine_chunks()
    y = fit["y"].to_numpy()
    pairs = []
    for name in ("a", "b"):
        lists = fit[name].combine_chunks()
        lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
        flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        pairs.append([flat[p:q] for p, q in zip(ends[:-1], ends[1:])])
    docs_in = list(zip(*pairs))
    model = fit_network(docs_in, y.astype(np.float32), ratio)

    named = table["lang"].combine_chunks()
    model.langs = sorted(x for x in named.unique().to_pylist() if x is not None)
    words = np.zeros((size + 1, max(1, len(model.langs))))
    if model.langs:
        words[at[spoken], pc.index_in(named, pa.array(model.langs)).to_numpy(zero_copy_only=False)[spoken].astype(np.int64)] = n0[spoken]
    model.lang_logp = np.log((words + 0.1) / (words[:size].sum(0) + 0.1 * size))
    model.lang_logp[size] = np.log((words[size] + 1) / (words[size] + 1).sum())
    model.lang_logp = model.lang_logp.astype(np.float32)
    bins = logit_bins(rows.where("apart").select(text_col, "_y"), model, bits)
    if not bins.num_rows:
        bins = logit_bins(rows.select(text_col, "_y"), model, bits)
    model.threshold = fit_thresholds(model, bins)
    del fit, pairs, docs_in, lists, flat
    release()
    return model


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``keep`` columns and ``score``: 0.5 is the threshold of the text's language. Null and empty texts are scored as no words."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    inner = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = inner.drop("_text").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Model(**shared.value)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for row, end, data, offsets in text_slices(batch.column(batch.num_columns - 1)):
                a, b, first = word_buckets(data, offsets, bits)
                raw = logits(net, a, b, first).astype(np.float64)
                cut = net.threshold[language(net, a, first)] if net.langs else net.threshold[0]
                out[row:end] = 1 / (1 + np.exp(-np.clip(raw - cut, -30, 30)))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.record_batch([*columns, pa.array(out)], schema.names)

    return inner.mapInArrow(run, schema)
