"""Language-model scoring by a gated recurrent network with a class-factored output, in numpy."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.words import Words, split_words, text_slices
from tallyfold.runtime import stage

VOCABULARY = 4_096  # words with an output weight of their own
CLASSES = 32  # they are dealt into, by frequency
TAIL_CLASSES = 32  # the other words are dealt into, by spelling
HIDDEN = 16
LANES = 512  # documents side by side
WINDOW = 32  # steps of backpropagation; states are carried from one window to the next
SCORE_WINDOW = 256  # the same in scoring
KNOWN = 1 << 18  # words whose counts every task holds; rarer ones are looked up by a join
CLASS_ROWS = 2_048  # rows whose class logits are made at once, so that they stay in a core's cache
FLUSH = 4_000_000
# The network starts on a bounded sample of training documents, in one task, and then goes on in every partition over all
# training documents; the partitions' weights are averaged, MERGE of them at a time.
WARM_TOKENS = 1_500_000
WARM_DOCS = 4_000
MERGE = 64
WARM_PART, TRAIN_PART = 150_000, 300_000  # tokens that are trained on at once
TRAIN_LANES = 128
WIDE_LANES, WIDE_WINDOW = 256, 64  # where there are more tokens than in the sample
TRAIN_PIECE = 512  # tokens
RATE = 0.1
END = 0x5EED0FE4D0C5A11E  # stands for the end of a text among word hashes
LN10 = math.log(10.0)


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, tail class, first token per document): each document's words and one end. The class comes from the last letters."""
    n, docs = len(words.hash), len(words.first) - 1
    h = np.full(n + docs, END, np.uint64)
    c = np.zeros(n + docs, np.uint8)
    at = np.arange(n) + words.doc()
    h[at] = words.hash
    last = words.data[words.end - 1].astype(np.uint32) if n else np.zeros(0, np.uint32)
    letter = (last >= 0x80) | ((last >= 0x61) & (last <= 0x7A))
    before = words.data[np.maximum(words.end - 2, words.start)].astype(np.uint32) if n else last
    code = np.where(letter, last * 256 + before, last) * np.uint32(0x9E3779B1)
    c[at] = (code >> np.uint32(16)) % TAIL_CLASSES
    return h, c, words.first + np.arange(docs + 1)


def count_tokens(docs: DataFrame, use: Column, text_col: str = "text") -> DataFrame:
    """(token, cls, n): how often each token stands in the documents where ``use`` holds. Tasks count first, Spark sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            h, c = (np.concatenate(v) for v in zip(*held))
            held.clear()
            value, at, n = np.unique(h, return_index=True, return_counts=True)
            return pa.record_batch([pa.array(value.view(np.int64)), pa.array(c[at].astype(np.int32)), pa.array(n)], ["token", "cls", "n"])

        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                h, c, _ = tokens(split_words(data, offsets))
                held.append((h, c))
                size += len(h)
                if size >= FLUSH:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    rows = docs.where(use).select(text_col).mapInArrow(run, "token long, cls int, n long")
    return rows.groupBy("token").agg(F.min("cls").alias("cls"), F.sum("n").alias("n"))


def new_model(head: np.ndarray, counts: np.ndarray, tail: np.ndarray, seed: int = 5) -> dict:
    """Weights for the head words (hashes by falling count); ``tail``: summed counts of the other words by class.

    Output offsets are the logs of the counts, so before any training the model is a unigram model by class and word.
    """
    rng = np.random.default_rng(seed)
    k = len(head)
    per = max(1, math.ceil(k / CLASSES))
    cls = np.arange(k) // per
    total = np.concatenate([np.bincount(cls, counts, CLASSES), tail]) + 0.5
    offset = np.log(total / total.sum())
    offset[:CLASSES][np.arange(CLASSES) * per >= k] = -30.0  # a class without words has no chance
    order = np.argsort(head)
    return {
        "sorted": head[order], "starts": prefix_starts(head[order]), "rank": order.astype(np.int32), "per": per,
        "wx": rng.normal(0, 0.1, (k + TAIL_CLASSES + 1, 3 * HIDDEN)).astype(np.float32),
        "u": rng.normal(0, 1 / math.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN)).astype(np.float32),
        "wc": np.zeros((HIDDEN, CLASSES + TAIL_CLASSES), np.float32), "bc": offset.astype(np.float32),
        "ww": np.zeros((k, HIDDEN), np.float32), "bw": np.log((counts + 0.5)).astype(np.float32),
    }


TRAINED = ("wx", "u", "wc", "bc", "ww", "bw")


def prefix_starts(table: np.ndarray) -> np.ndarray:
    """For each value of the first bits, of which there are about four times as many as hashes, its first place in a sorted table; the end last."""
    bits = max(1, len(table).bit_length() + 2)
    return np.append(np.searchsorted(table, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)), len(table)).astype(np.int32)


def lookup(table: np.ndarray, h: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Places of hashes in a sorted table, -1 for those that are not in it. Few hashes of the table share their first bits, so few are compared."""
    starts = prefix_starts(table) if starts is None else starts
    prefix = (h >> np.uint64(65 - (len(starts) - 1).bit_length())).astype(np.int32)
    at, end = starts[prefix], starts[prefix + 1]
    out = np.full(len(h), -1, np.int32)
    left = np.flatnonzero(at < end)
    at, end, h = at[left], end[left], h[left]
    while len(left):
        hit = table[at] == h
        out[left[hit]] = at[hit]
        at += 1
        more = np.flatnonzero(~hit & (at < end))
        left, at, end, h = left[more], at[more], end[more], h[more]
    return out


def symbols(model: dict, h: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Input and target numbers: head words by rank, then tail classes."""
    if not len(model["rank"]):
        return cls.astype(np.int32)
    at = lookup(model["sorted"], h, model["starts"])
    return np.where(at >= 0, model["rank"][at], len(model["rank"]) + cls.astype(np.int32)).astype(np.int32)


def lanes(first: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Deal documents to lanes of near equal length, longest first: (document order, first document per lane, lane lengths falling)."""
    size = np.diff(first)
    width = int(max(1, min(most, len(size), size.sum() // max(1, size.max(initial=1)) + 1)))
    order = np.argsort(-size, kind="stable")
    turn = np.arange(len(order)) % (2 * width)
    lane = np.where(turn < width, turn, 2 * width - 1 - turn)  # there and back again
    length = np.bincount(lane, size[order], width).astype(np.int64)
    rank = np.empty(width, np.int64)
    rank[np.argsort(-length, kind="stable")] = np.arange(width)
    lane = rank[lane]
    dealt = order[np.argsort(lane, kind="stable")]
    return dealt, np.searchsorted(np.sort(lane), np.arange(width + 1)), np.sort(length)[::-1]


def _laid_out(ids: np.ndarray, first: np.ndarray, most: int):
    """Token numbers in lane order: (target, input, starts, document, lane offsets, lane lengths)."""
    order, _, length = lanes(first, most)
    size = np.diff(first)[order]
    ends = np.cumsum(size)
    src = np.repeat(first[order] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    target = ids[src]
    doc = np.repeat(order, size)
    begins = np.zeros(len(src), bool)
    begins[(ends - size)[size > 0]] = True
    return target, begins, doc, np.concatenate([[0], np.cumsum(length)[:-1]]), length


def _window(offset: np.ndarray, length: np.ndarray, t0: int, t1: int) -> tuple[np.ndarray, np.ndarray]:
    """The steps of a window one after the other: (first row of each step and the end, token of each row). Longer lanes come first."""
    live = np.searchsorted(-length, -np.arange(t0, t1))
    return np.concatenate([[0], np.cumsum(live)]), np.concatenate([offset[:n] + t for n, t in zip(live, range(t0, t1))])


def _gates(u: np.ndarray, x: np.ndarray, h: np.ndarray):
    a = h @ u
    zr = x[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN]
    zr *= 0.5
    np.tanh(zr, out=zr)
    zr += 1
    zr *= 0.5
    z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
    an = a[:, 2 * HIDDEN :]
    n = r * an
    n += x[:, 2 * HIDDEN :]
    np.tanh(n, out=n)
    after = h - n
    after *= z
    after += n
    return zr, an, n, after


def _log_softmax_pick(logits: np.ndarray, pick: np.ndarray, safe: bool) -> np.ndarray:
    if not safe:
        logits -= logits.max(1, keepdims=True)
    chosen = logits[np.arange(len(pick)), pick]
    np.exp(logits, out=logits)
    return chosen - np.log(_row_sums(logits))


def _small_weights(model: dict) -> list[bool]:
    """Whether no logit of a class, or of a word in it, can overflow: states lie between -1 and 1."""
    return [max(np.abs(model[w]).sum(axis).max(initial=0), np.abs(model[b]).max(initial=0)) < 40 for w, b, axis in (("wc", "bc", 0), ("ww", "bw", 1))]


def _by_class(cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows whose class has words of its own, by class; where each class begins)."""
    short = cls.astype(np.uint8 if CLASSES + TAIL_CLASSES <= 256 else np.int64)  # small numbers are sorted by counting
    ends = np.concatenate([[0], np.cumsum(np.bincount(cls, minlength=CLASSES)[:CLASSES])])
    return np.argsort(short, kind="stable")[: ends[-1]], ends


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)


def _column_sums(x: np.ndarray) -> np.ndarray:
    return np.ones(len(x), x.dtype) @ x


def _blocks(n: int) -> Iterator[slice]:
    return (slice(lo, lo + CLASS_ROWS) for lo in range(0, n, CLASS_ROWS))


def _error(logits: np.ndarray, pick: np.ndarray, scale: np.float32, safe: bool) -> tuple[np.ndarray, float]:
    """(``scale`` times the gradient of the loss by the logits, in their place; the loss)."""
    if not safe:
        logits -= logits.max(1, keepdims=True)
    at = np.arange(len(pick))
    chosen = logits[at, pick]
    np.exp(logits, out=logits)
    sums = _row_sums(logits)
    logits *= (scale / sums)[:, None]
    logits[at, pick] -= scale
    return logits, float((np.log(sums) - chosen).sum())


def log_probs(model: dict, states: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log of P(class) and, for head words, of P(word in class), at each state.

    States lie between -1 and 1, so where all weights are small no logit can overflow and its maximum need not be found.
    """
    safe = _small_weights(model)
    k, per = len(model["rank"]), model["per"]
    head = target < k
    cls = np.where(head, target // per, CLASSES + target - k)
    logits = states @ model["wc"]
    logits += model["bc"]
    out = _log_softmax_pick(logits, cls, safe[0]).astype(np.float64)
    rows, ends = _by_class(cls)
    states, target, word = states[rows], target[rows], np.empty(len(rows))
    for c in np.flatnonzero(np.diff(ends)):
        part = slice(ends[c], ends[c + 1])
        lo, hi = c * per, min((c + 1) * per, k)
        logits = states[part] @ model["ww"][lo:hi].T
        logits += model["bw"][lo:hi]
        word[part] = _log_softmax_pick(logits, target[part] - lo, safe[1])
    out[rows] += word
    return out


def score_tokens(model: dict, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Log probability of each document. Windows of all lanes follow each other; states go on from one to the next."""
    docs = len(first) - 1
    total = np.zeros(docs)
    if not docs:
        return total
    target, begins, doc, offset, length = _laid_out(ids, first, LANES)
    source = np.empty_like(target)
    source[1:] = target[:-1]
    source[begins] = len(model["wx"]) - 1  # what stands before a text
    h = np.zeros((len(length), HIDDEN), np.float32)
    for t0 in range(0, int(length[0]), SCORE_WINDOW):
        starts, places = _window(offset, length, t0, min(t0 + SCORE_WINDOW, int(length[0])))
        x = model["wx"][source[places]]
        keep = (~begins[places]).astype(np.float32)[:, None]
        states = np.empty((len(places), HIDDEN), np.float32)
        for lo, hi in zip(starts[:-1], starts[1:]):
            h = states[lo:hi] = _gates(model["u"], x[lo:hi], h[: hi - lo] * keep[lo:hi])[-1]
        total += np.bincount(doc[places], log_probs(model, states, target[places]), docs)
    return total


class Learner:
    """Truncated backpropagation through ``window`` steps of ``lanes`` texts, Adagrad on every weight."""

    def __init__(self, model: dict, rate: float = RATE, lanes: int = TRAIN_LANES, window: int = WINDOW):
        self.m, self.rate, self.lanes, self.window = model, rate, lanes, window
        self.past = {k: np.full(model[k].shape, 1e-2, np.float32) for k in TRAINED}

    def _move(self, key: str, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        if rows is None:
            self.past[key] += grad * grad
            self.m[key] -= self.rate * grad / np.sqrt(self.past[key])
        else:
            self.past[key][rows] += grad * grad
            self.m[key][rows] -= self.rate * grad / np.sqrt(self.past[key][rows])

    def _output(self, states: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
        m, scale = self.m, np.float32(1 / self.lanes)
        k, per = len(m["rank"]), m["per"]
        head = target < k
        cls = np.where(head, target // per, CLASSES + target - k)
        safe = _small_weights(m)
        d, loss = np.empty_like(states), 0.0
        d_wc, d_bc = np.zeros_like(m["wc"]), np.zeros_like(m["bc"])
        for part in _blocks(len(target)):
            logits = states[part] @ m["wc"]
            logits += m["bc"]
            p, more = _error(logits, cls[part], scale, safe[0])
            loss += more
            d[part] = p @ m["wc"].T
            d_wc += states[part].T @ p
            d_bc += _column_sums(p)
        grads = [("wc", d_wc, None), ("bc", d_bc, None)]
        rows, ends = _by_class(cls)
        states, target, d_word = states[rows], target[rows], np.empty((len(rows), HIDDEN), np.float32)
        for c in np.flatnonzero(np.diff(ends)):
            part = slice(ends[c], ends[c + 1])
            span = slice(c * per, min((c + 1) * per, k))
            s = states[part]
            logits = s @ m["ww"][span].T
            logits += m["bw"][span]
            q, more = _error(logits, target[part] - span.start, scale, safe[1])
            loss += more
            d_word[part] = q @ m["ww"][span]
            grads += [("ww", q.T @ s, span), ("bw", _column_sums(q), span)]
        d[rows] += d_word
        for key, g, span in grads:
            self._move(key, g, span)
        return d, loss

    def fit(self, ids: np.ndarray, first: np.ndarray) -> float:
        m = self.m
        size = np.diff(first)  # long texts are cut for training, so that lanes are of near equal length
        cuts = np.maximum(1, -(-size // TRAIN_PIECE))
        at = np.repeat(first[:-1], cuts) + (np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * TRAIN_PIECE
        target, begins, _, offset, length = _laid_out(ids, np.append(at, first[-1]), self.lanes)
        if not len(target):
            return 0.0
        source = np.empty_like(target)
        source[1:] = target[:-1]
        source[begins] = len(m["wx"]) - 1
        h = np.zeros((len(length), HIDDEN), np.float32)
        loss = 0.0
        for t0 in range(0, int(length[0]), self.window):
            starts, places = _window(offset, length, t0, min(t0 + self.window, int(length[0])))
            rows = source[places]
            x = m["wx"][rows]
            keep = (~begins[places]).astype(np.float32)[:, None]
            before, zr, an, n, states = (np.empty((len(places), w * HIDDEN), np.float32) for w in (1, 2, 1, 1, 1))
            now = h
            for lo, hi in zip(starts[:-1], starts[1:]):
                before[lo:hi] = now[: hi - lo] * keep[lo:hi]
                zr[lo:hi], an[lo:hi], n[lo:hi], states[lo:hi] = _gates(m["u"], x[lo:hi], before[lo:hi])
                now = states[lo:hi]
                h[: hi - lo] = now
            d_out, part = self._output(states, target[places])
            loss += part
            # What a step's error is multiplied by does not depend on the error: all steps at once.
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            by_n = (1 - z) * (1 - n * n)
            by_z = (before - n) * z * (1 - z)
            by_r = an * r * (1 - r)
            d_x, d_a = np.empty_like(x), np.empty_like(x)
            carried = np.zeros_like(h)
            for lo, hi in zip(starts[-2::-1], starts[:0:-1]):
                d = d_out[lo:hi] + carried[: hi - lo]
                d_n = np.multiply(d, by_n[lo:hi], out=d_x[lo:hi, 2 * HIDDEN :])
                a = d_a[lo:hi]
                np.multiply(d, by_z[lo:hi], out=a[:, :HIDDEN])
                np.multiply(d_n, by_r[lo:hi], out=a[:, HIDDEN : 2 * HIDDEN])
                np.multiply(d_n, r[lo:hi], out=a[:, 2 * HIDDEN :])
                d *= z[lo:hi]
                d += a @ m["u"].T
                np.multiply(d, keep[lo:hi], out=carried[: hi - lo])
            d_x[:, : 2 * HIDDEN] = d_a[:, : 2 * HIDDEN]
            self._move("u", np.clip(before.T @ d_a, -1, 1))
            used = np.flatnonzero(np.bincount(rows, minlength=len(m["wx"])))
            sums = np.stack([np.bincount(rows, column, len(m["wx"]))[used] for column in d_x.T], 1).astype(np.float32)
            self._move("wx", np.clip(sums, -1, 1), used)
        return loss


def _ids(model: dict, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, _, data, offsets in text_slices(column):
        h, c, first = tokens(split_words(data, offsets))
        yield symbols(model, h, c), first


def _blob(model: dict) -> bytes:
    return b"".join(np.ascontiguousarray(model[k], np.float32).tobytes() for k in TRAINED)


def _pack(model: dict, weight: int) -> pa.RecordBatch:
    learner = TaskContext.get().partitionId()
    columns = [pa.array([learner], pa.int64()), pa.array([weight], pa.int64()), pa.array([_blob(model)], pa.binary())]
    return pa.record_batch(columns, ["learner", "weight", "weights"])


def _unpack(model: dict, blob: bytes) -> dict:
    out, at = dict(model), 0
    for k in TRAINED:
        size = model[k].size
        out[k] = np.frombuffer(blob, np.float32, size, at).reshape(model[k].shape).copy()
        at += 4 * size
    return out


def train(docs: DataFrame, use: Column, model: dict, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The model fitted on documents where ``use`` holds: first on a bounded sample, then on all of them, by partition.

    Each partition streams its documents through a copy of the network; the copies are averaged by their tokens, in groups
    of MERGE, so that neither a task nor the driver holds more than MERGE of them (about a megabyte each).
    """
    spark = docs.sparkSession
    base = {k: v for k, v in model.items()}
    h = F.xxhash64(F.lit(21), F.col(id_col).cast("string"), F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))

    def warm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner({k: v.copy() if isinstance(v, np.ndarray) else v for k, v in base.items()})
        parts = list(_gathered((p for batch in batches for p in _ids(base, batch.column(0))), WARM_PART))
        seen = 0
        for _ in range(6):
            for ids, first in parts:
                if seen < WARM_TOKENS:
                    learner.fit(ids, first)
                    seen += len(ids)
        yield _pack(learner.m, seen)

    rows = docs.where(use)
    ids = rows.select(h.alias("h")).orderBy("h").limit(WARM_DOCS)
    cut = ids.agg(F.max("h")).first()[0]
    if cut is None:
        return model
    first = rows.where(h <= cut).select(text_col).repartition(1).mapInArrow(warm, "learner long, weight long, weights binary").first()
    base = _unpack(model, first["weights"])
    shared = spark.sparkContext.broadcast(base)

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        learner = Learner({k: v.copy() if isinstance(v, np.ndarray) else v for k, v in start.items()}, RATE / 4, WIDE_LANES, WIDE_WINDOW)
        seen = 0
        for ids, first in _gathered((p for batch in batches for p in _ids(start, batch.column(0))), TRAIN_PART):
            learner.fit(ids, first)
            seen += len(ids)
        if seen:
            yield _pack(learner.m, seen)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        mean = _mean(base, zip(pdf["weight"], pdf["weights"]))
        return pd.DataFrame({"learner": pdf["learner"].iloc[:1] // MERGE, "weight": [int(pdf["weight"].sum())], "weights": [_blob(mean)]})

    schema = "learner long, weight long, weights binary"
    found = stage(rows.select(text_col).mapInArrow(go_on, schema), "lm")
    while (found.agg(F.max("learner")).first()[0] or 0) >= MERGE:
        found = stage(found.groupBy(F.expr(f"learner div {MERGE}")).applyInPandas(merge, schema), "lm")
    return _mean(base, ((r["weight"], r["weights"]) for r in found.collect()))


def _mean(base: dict, weighted: Iterable[tuple[int, bytes]]) -> dict:
    """The average of packed weights by their number of tokens; ``base`` if there are none."""
    total, sums = 0, {k: np.zeros(base[k].shape) for k in TRAINED}
    for weight, blob in weighted:
        one = _unpack(base, blob)
        total += weight
        for k in TRAINED:
            sums[k] += weight * one[k].astype(np.float64)
    return base if not total else base | {k: (sums[k] / total).astype(np.float32) for k in TRAINED}


def _gathered(parts: Iterable[tuple[np.ndarray, np.ndarray]], least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slices joined until they have at least so many tokens; the last one may have less."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= least:
            yield _joined(held)
            held, size = [], 0
    if size:
        yield _joined(held)


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    base = np.cumsum([0, *(len(ids) for ids, _ in parts)])
    first = np.concatenate([f[:-1] + b for (_, f), b in zip(parts, base)] + [base[-1:]])
    return np.concatenate([ids for ids, _ in parts]), first


def score_documents(docs: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row; log10 probabilities.

    ``base_score`` is an add-half unigram over the training tokens (documents where ``use`` holds). ``score`` is the network's:
    the class of each token given all tokens before it in the document, then the word in its class: by the network
    for the VOCABULARY most frequent words, by add-half counts for the others, with one unknown word in each class. A
    null or empty text is one end token. Rows may repeat; without training rows every token is unknown.
    """
    spark = docs.sparkSession
    counts = stage(count_tokens(docs, use, text_col), "lm")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.col("n").desc(), "token").limit(KNOWN).toArrow()
    top_h, top_n = top["token"].to_numpy().view(np.uint64), top["n"].to_numpy()
    by_count = np.lexsort((top_h, -top_n))
    head, head_n = top_h[by_count][:VOCABULARY], top_n[by_count][:VOCABULARY]
    by_class = counts.groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas().set_index("cls")
    head_c = top["cls"].to_numpy()[by_count][:VOCABULARY]
    tail_n = np.zeros(TAIL_CLASSES)
    tail_v = np.zeros(TAIL_CLASSES)
    tail_n[by_class.index], tail_v[by_class.index] = by_class["n"], by_class["v"]
    tail_n -= np.bincount(head_c, head_n, TAIL_CLASSES)
    tail_v -= np.bincount(head_c, minlength=TAIL_CLASSES)
    model = train(docs, use, new_model(head, head_n, tail_n), id_col, text_col)

    known = np.argsort(top_h)
    per_class = np.log10(tail_n + 0.5 * (tail_v + 1))
    base_total = math.log10(n + 0.5 * (v + 1))
    rank = np.empty(len(top_h), np.int32)
    rank[by_count] = np.arange(len(top_h))
    shared = spark.sparkContext.broadcast({"model": model, "h": top_h[known], "starts": prefix_starts(top_h[known]), "n": top_n[known], "rank": rank[known]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = shared.value
        net, known_h, starts, rank = box["model"], box["h"], box["starts"], np.append(box["rank"], KNOWN)
        # The last entries are for words that are not known.
        known_base = np.append(np.log10(box["n"] + 0.5) - base_total, 0.0)
        known_tail = np.where(rank < len(net["rank"]), 0.0, np.append(np.log10(box["n"] + 0.5), 0.0))
        row_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, firsts, out = [], [], []
            for row, end, data, offsets in text_slices(batch.column(1)):
                h, c, first = tokens(split_words(data, offsets))
                at = lookup(known_h, h, starts)
                hit = at >= 0
                doc = np.repeat(np.arange(end - row), np.diff(first))
                docs_here = end - row
                place = rank[at]
                base = np.bincount(doc, known_base[at], docs_here)
                tail = np.flatnonzero(hit & (place >= len(net["rank"])))
                word = np.bincount(doc[tail], known_tail[at[tail]] - per_class[c[tail]], docs_here)
                rare = np.flatnonzero(~hit)
                lists = [pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, first), pa.int32()), pa.array(x[rare])) for x in (h.view(np.int64), c.astype(np.int32))]
                out.append((np.diff(first), np.bincount(doc, hit, docs_here).astype(np.int64), base, word, *lists))
                ids.append(np.where(place < len(net["rank"]), place, len(net["rank"]) + c.astype(np.int32)))
                firsts.append(first)
            if not out:
                continue
            score = score_tokens(net, *_joined(list(zip(ids, firsts)))) / LN10
            n_tokens, n_known, base, word = (np.concatenate([o[k] for o in out]) for k in range(4))
            rare_h, rare_c = (pa.concat_arrays([o[k] for o in out]) for k in (4, 5))
            names = ["row_id", "doc_id", "n_tokens", "n_known", "base", "model", "rare", "rare_cls"]
            yield pa.record_batch(
                [pa.array(row_id + np.arange(len(base))), batch.column(0), pa.array(n_tokens), pa.array(n_known), pa.array(base), pa.array(score + word), rare_h, rare_c], names
            )
            row_id += len(base)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"row_id long, doc_id {kind}, n_tokens long, n_known long, base double, model double, rare array<long>, rare_cls array<int>"
    scored = stage(docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, schema), "lm")
    # Rare tokens meet their counts by a join; equal ones of a document are one row.
    pairs = scored.where(F.size("rare") > 0).select("row_id", F.explode(F.arrays_zip("rare", "rare_cls")).alias("t"))
    pairs = pairs.select("row_id", F.col("t.rare").alias("token"), F.col("t.rare_cls").alias("c"))
    met = pairs.join(counts.select("token", "n"), "token", "left")
    value = F.log10(F.coalesce("n", F.lit(0)) + 0.5)
    class_total = F.element_at(F.array(*[F.lit(float(x)) for x in per_class]), F.col("c") + 1)
    rare = met.groupBy("row_id").agg(
        F.count("n").alias("more_known"), F.sum(value - base_total).alias("more_base"), F.sum(value - class_total).alias("more_model")
    )
    out = scored.drop("rare", "rare_cls").join(rare, "row_id", "left")
    return out.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(int(n)).alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), (F.col("model") + F.coalesce("more_model", F.lit(0.0))).alias("score"),
    )
