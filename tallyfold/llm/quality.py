"""Quality classifier: naive Bayes features in a linear support vector machine (NB-SVM)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.fitting import bounded_sample, fit_logistic
from tallyfold.llm.parts import with_small
from tallyfold.llm.words import Words, mix, release, split_words, text_slices

BITS = 18
# Rows the support vectors are fitted on; class counts of the indicators come from all labelled rows.
MAX_FIT_ROWS = 8_000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
_KINDS = np.array([0x1000193, 0x1000A6B, 0x10014F3, 0x1001CD5], np.uint64)


def shapes(words: Words) -> np.ndarray:
    """A small code per word: its length, cases, last character and whether it repeats the word before."""
    data, start, end = words.data, words.start, words.end
    upper = np.zeros(len(data) + 1, np.int32)
    np.cumsum((data >= 0x41) & (data <= 0x5A), out=upper[1:])
    length = end - start
    n_upper = upper[end] - upper[start]
    case = np.where(n_upper == 0, 0, np.where(n_upper * 2 > length, 2, 1))
    last = data[end - 1]
    mark = np.where((last >= 0x80) | ((last | 0x20) >= 0x61) & ((last | 0x20) <= 0x7A), 0, last)
    again = np.zeros(len(start), np.int64)
    if len(start) > 1:
        again[1:] = words.hash[1:] == words.hash[:-1]
    return ((np.minimum(length, 15).astype(np.int64) * 3 + case) * 256 + mark) * 2 + again


def indicators(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each document, sorted by document: (buckets, first index per document).

    Hashed are words, pairs of words, word shapes and pairs of shapes, with case kept.
    """
    words = split_words(data, offsets, fold=False)
    docs = len(offsets) - 1
    doc = words.doc()
    with np.errstate(over="ignore"):
        shape = mix(shapes(words).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        pair = doc[1:] == doc[:-1]
        hashes = [
            mix(words.hash + _KINDS[0]),
            mix(words.hash[:-1] * np.uint64(3) + words.hash[1:] + _KINDS[1])[pair],
            mix(shape + _KINDS[2]),
            mix(shape[:-1] * np.uint64(3) + shape[1:] + _KINDS[3])[pair],
        ]
    owner = np.concatenate([doc, doc[1:][pair], doc, doc[1:][pair]])
    key = (owner << bits) | (np.concatenate(hashes) & np.uint64((1 << bits) - 1)).astype(np.int64)
    key = np.unique(key)
    return key & ((1 << bits) - 1), np.searchsorted(key, np.arange(docs + 1) << bits)


@dataclass
class Model:
    weight: np.ndarray  # per bucket, the log-count ratio already multiplied in; float32
    bias: float
    slope: float
    offset: float


def _score(model: Model, data: np.ndarray, offsets: np.ndarray, bits: int) -> np.ndarray:
    bucket, first = indicators(data, offsets, bits)
    sums = np.zeros(len(bucket) + 1)
    np.cumsum(model.weight[bucket], out=sums[1:])
    n = np.diff(first)
    margin = (sums[first[1:]] - sums[first[:-1]]) / np.sqrt(np.maximum(n, 1)) + model.bias
    return 1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -30, 30)))


def dual_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, epochs: int, seed: int = 3) -> tuple[np.ndarray, float]:
    """Hinge-loss weights over ratio-scaled indicators of unit length, one dual coordinate after another."""
    w, bias = np.zeros(len(ratio)), 0.0
    alpha = np.zeros(len(rows))
    values = [ratio[r] / np.sqrt(max(1, len(r))) for r in rows]
    norm = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            r, v = rows[i], values[i]
            g = y[i] * (w[r] @ v + bias) - 1.0
            new = min(max(alpha[i] - g / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                w[r] += step * v
                bias += step
                worst = max(worst, abs(step))
        if worst < 1e-4:
            break
    return w, bias


def train(docs: DataFrame, labels: DataFrame, use: Column, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          bits: int = BITS, max_fit_rows: int = MAX_FIT_ROWS, smoothing: float = SMOOTHING) -> Model:
    """Fit on the labelled rows where ``use`` holds.

    Class counts of every bucket come from all of them, summed by Spark to one number per bucket and class. The support
    vectors and the score curve are fitted on at most ``max_fit_rows`` rows: three quarters and one quarter of them.
    Rows whose label is null are left out. Without labels every score is 0.5, with one class only it is that class.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(id_col).agg(F.max(label).cast("int").alias("_y"))
    rows = with_small(docs.where(use).select(id_col, text_col), known, [id_col]).select(id_col, text_col, "_y")
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size), np.int64)
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for row, end, data, offsets in text_slices(batch.column(0)):
                bucket, first = indicators(data, offsets, bits)
                by = np.repeat(y[row:end], np.diff(first))
                for c in (0, 1):
                    sums[c] += np.bincount(bucket[by == c], minlength=size)
        at = np.flatnonzero(sums.any(0))
        yield pa.record_batch([pa.array(at), pa.array(sums[0][at]), pa.array(sums[1][at])], ["bucket", "n0", "n1"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column(0)):
                bucket, first = indicators(data, offsets, bits)
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(bucket, pa.int32()))
                part = batch.slice(row, end - row)
                yield pa.record_batch([part.column(1), part.column(2), lists], ["y", "h", "buckets"])

    counted = rows.select(text_col, "_y").mapInArrow(count, "bucket long, n0 long, n1 long")
    table = counted.groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    n = np.zeros((2, size))
    at = table["bucket"].to_numpy(np.int64)
    n[0, at], n[1, at] = table["n0"], table["n1"]
    p = n + smoothing
    ratio = np.log(p[1] / p[1].sum()) - np.log(p[0] / p[0].sum())

    sample, sizes = bounded_sample(rows, "_y", id_col, max_fit_rows)
    if len(sizes) < 2:
        flat = 0.5 if not sizes else float(next(iter(sizes)))
        return Model(np.zeros(size, np.float32), 0.0, 0.0, float(np.clip(np.log((flat + 1e-9) / (1 - flat + 1e-9)), -30, 30)))
    h = F.xxhash64(F.lit(5), F.col(id_col).cast("string"))
    fit = sample.select(text_col, "_y", h.alias("h")).mapInArrow(features, "y int, h long, buckets array<int>").toArrow().sort_by("h")
    y = fit["y"].to_numpy()
    lists = fit["buckets"].combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    buckets = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
    share = {c: sizes[c] / max(1, (y == c).sum()) for c in sizes}
    hold = np.zeros(len(y), bool)
    hold[::4] = True
    sign = np.where(y == 1, 1.0, -1.0)

    def fitted(rows_in: np.ndarray) -> tuple[np.ndarray, float]:
        return dual_descent([buckets[i] for i in rows_in], sign[rows_in], ratio, np.full(len(rows_in), COST), EPOCHS)

    w, bias = fitted(np.flatnonzero(~hold))
    apart = np.flatnonzero(hold)
    margin = np.array([(w * ratio)[buckets[i]].sum() / np.sqrt(max(1, len(buckets[i]))) + bias for i in apart])
    slope, offset = fit_logistic(margin, y[apart], np.array([share[c] for c in y[apart]]))
    del fit, lists, flat, buckets
    release()
    return Model((w * ratio).astype(np.float32), bias, slope, offset)


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", bits: int = BITS, out: str = "score") -> DataFrame:
    """``keep`` columns and ``out``, the chance of label 1. A null text is scored as the empty text, as are texts without words."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    columns = [*keep, *([] if text_col in keep else [text_col])]
    inner, at = docs.select(*[F.col(f"`{c}`") for c in columns]), columns.index(text_col)
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add(out, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Model(**shared.value)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for row, end, data, offsets in text_slices(batch.column(at)):
                scores[row:end] = _score(net, data, offsets, bits)
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(scores)], schema.names)

    return inner.mapInArrow(run, schema)


def with_score(docs: DataFrame, model: Model, out: str, text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` with its score as the column ``out``. Only texts go to Python and only scores come back: rows wait where they are."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.arrow_udf("double")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = Model(**shared.value)
        for text in texts:
            scores = np.zeros(len(text))
            for row, end, data, offsets in text_slices(text):
                scores[row:end] = _score(net, data, offsets, bits)
            yield pa.array(scores)

    return docs.withColumn(out, run(F.col(f"`{text_col}`")))
