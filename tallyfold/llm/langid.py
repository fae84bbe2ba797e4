"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.words import segment_sum, text_slices

BITS = 15
SMOOTHING = 0.5
UNKNOWN = "und"
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


LOW = 0x3000  # code points below are looked up in a table made once per task, the others one distinct point at a time
_tables: dict[str, np.ndarray] = {}


def fold_letters(cp: np.ndarray) -> np.ndarray:
    """Code points -> lower-case letters, 0 for what is no letter."""

    def one(i: int) -> int:
        c = chr(i)
        low = c.lower()
        return 0 if not c.isalpha() else ord(low) if len(low) == 1 else i

    if "low" not in _tables:
        _tables["low"] = np.array([one(i) for i in range(LOW)], np.uint32)
    out = _tables["low"][np.minimum(cp, LOW - 1)]
    high = np.flatnonzero(cp >= LOW)
    if len(high):
        points, inverse = np.unique(np.minimum(cp[high], 0x10FFFF), return_inverse=True)
        out[high] = np.array([one(int(i)) for i in points], np.uint32)[inverse]
    return out


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of UTF-8 bytes, 0 for each other character, and each document's first one."""
    b = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = b[at]
    cp = lead.copy()
    for width, low, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        rows = np.flatnonzero(lead >= low)
        if not len(rows):
            break
        value = lead[rows] & np.uint32(mask)
        for k in range(1, width):
            value = (value << np.uint32(6)) | (b[at[rows] + k] & np.uint32(0x3F))
        cp[rows] = value
    return fold_letters(cp), np.searchsorted(at, offsets)


def ngram_buckets(c: np.ndarray, first: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1, 2, 3: (bucket, position) of each n-gram whose middle is a letter; none spans two documents."""
    for n in (1, 2, 3):
        size = len(c) - n + 1
        if size <= 0:
            return
        ok = c[(n - 1) // 2 : (n - 1) // 2 + size] != 0
        for back in range(1, n):  # windows that begin shortly before a document's first character
            edge = first[1:-1] - back
            ok[edge[(edge >= 0) & (edge < size)]] = False
        at = np.flatnonzero(ok)
        h = np.full(len(at), n * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
        with np.errstate(over="ignore"):
            for k in range(n):
                h += c[at + k] * _MULTIPLIERS[k]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            h ^= h >> np.uint32(13)
        yield h & np.uint32((1 << bits) - 1), at


def train(docs: DataFrame, use: Column, text_col: str = "text", lang_col: str = "lang", bits: int = BITS) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities) from the rows where ``use`` holds and the language is not null.

    Tasks add up one count per language and bucket, Spark sums them; the table that reaches the driver has languages x
    buckets numbers at most, whatever the input. The last column holds the log prior of each language (by documents).
    """
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for row, end, data, offsets in text_slices(batch.column(0)):
                c, first = letters(data, offsets)
                names, codes = np.unique(langs[row:end].astype(str), return_inverse=True)
                for name, docs_here in zip(names, np.bincount(codes)):
                    totals.setdefault(name, np.zeros(size + 1, np.int64))[size] += docs_here
                for bucket, at in ngram_buckets(c, first, bits):
                    code = codes[np.searchsorted(first, at, "right") - 1]
                    sums = np.bincount(code * size + bucket, minlength=len(names) * size).reshape(len(names), size)
                    for name, row_sums in zip(names, sums):
                        totals[name][:size] += row_sums
        for name, sums in totals.items():
            at = np.flatnonzero(sums)
            yield pa.record_batch([pa.array([name] * len(at)), pa.array(at), pa.array(sums[at])], ["lang", "bucket", "n"])

    rows = docs.where(use & F.col(lang_col).isNotNull()).select(text_col, lang_col)
    counts = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    langs = sorted(found["lang"].unique())
    table = np.zeros((len(langs), size + 1))
    table[np.searchsorted(langs, found["lang"]), found["bucket"].to_numpy(np.int64)] = found["n"]
    logp = np.empty_like(table)
    grams = table[:, :size] + SMOOTHING
    logp[:, :size] = np.log(grams / grams.sum(1, keepdims=True))
    logp[:, size] = np.log(table[:, size] / max(1, table[:, size].sum()))
    return langs, logp


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, lang_pred and score (posterior of the predicted language) of each row.

    A text that is null or has no letter is ``und`` with score 0, as is every text if no language was learned. Ties go
    to the first language by code point. Whole texts are scored, slice by slice.
    """
    spark = docs.sparkSession
    langs, logp = model
    size = logp.shape[1] - 1
    shared = spark.sparkContext.broadcast((langs, logp.astype(np.float32)))
    inner = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = inner.drop("_text").schema.add("lang_pred", "string").add("score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        bits = int(size).bit_length() - 1
        for batch in batches:
            n = batch.num_rows
            total = np.zeros((n, len(names)))
            total += table[:, size]
            seen = np.zeros(n, bool)
            for row, end, data, offsets in text_slices(batch.column(batch.num_columns - 1)):
                c, first = letters(data, offsets)
                seen[row:end] = segment_sum((c != 0).astype(np.float64), first) > 0
                for bucket, at in ngram_buckets(c, first, bits):
                    bounds = np.searchsorted(at, first)
                    for k in range(len(names)):
                        total[row:end, k] += segment_sum(table[k][bucket], bounds)
            if names:
                best = total.argmax(1)
                with np.errstate(under="ignore"):
                    p = 1.0 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                label = np.where(seen, np.array(names, object)[best], UNKNOWN)
                p = np.where(seen, p, 0.0)
            else:
                label, p = np.full(n, UNKNOWN, object), np.zeros(n)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.record_batch([*columns, pa.array(label, pa.string()), pa.array(p)], [*schema.names])

    return inner.mapInArrow(score, schema)
