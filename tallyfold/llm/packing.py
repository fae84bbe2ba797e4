"""Packing by power-of-two decomposition: documents become pieces of binary length, and no sequence crosses documents.

A document's ids, with an end id, are cut into as many pieces of the largest length as fit, then into the binary digits of
the rest, longest first. Pieces of one length form a bucket; each piece is a sequence of its own and needs no padding.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from tallyfold.llm.parts import with_small
from tallyfold.llm.words import release
from tallyfold.runtime import stage

MAX_LENGTH = 1024
FLUSH_CHARS = 1 << 18  # characters per batch that is given away
SLICE_CHARS = 1 << 18  # a longer text is encoded in slices

# How byte-level vocabularies split text and write bytes as characters.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes written as themselves; the others from U+0100 on

# What is surely a letter, a digit, a mark or white space to every engine of patterns.
UNSURE = re.compile("[^\n\t -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f\u0391-\u03a1\u03b1-\u03c9\u0410-\u044f\u2010-\u2015\u2018-\u201f\u2026\u20ac]")


def plain(text: str) -> bool:
    """Whether no character is in doubt and no run of white space (64) or of anything else (256) is very long."""
    if UNSURE.search(text):
        return False
    blocks = (text[i : i + 128] for i in range(0, len(text) - 127, 128))
    if not all(" " in b or "\n" in b for b in blocks):
        return False
    return not any(text[i : i + 32].isspace() for i in range(0, len(text) - 31, 32))


def slices(text: str, limit: int = SLICE_CHARS) -> list[str]:
    """Text cut, where it is longer than ``limit``, before spaces that follow a letter, a digit or printable ASCII.

    Byte-level BPE splits text by a pattern none of whose matches holds white space after anything else, and which looks ahead
    only from white space. So each such place is a border of matches, and the slices have the ids that the whole text has.
    """
    out, at, look = [], 0, limit
    while len(text) - at > limit:
        cut = text.find(" ", at + look)
        if cut < 0:
            break
        before = text[cut - 1]
        if "!" <= before <= "~" or before.isalnum():
            out.append(text[at:cut])
            at, look = cut, limit
        else:
            look = cut - at + 1
    return [*out, text[at:]]


def byte_ranks(vocabulary: dict) -> dict[bytes, int] | None:
    """Tokens as bytes with their ids, if ids are in the order of the merges and text is split in the usual way; else nothing."""
    model, split = vocabulary["model"], vocabulary["pre_tokenizer"] or {}
    usual = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if model.get("type", "BPE") != "BPE" or vocabulary["normalizer"] or not usual:
        return None
    hidden = [b for b in range(256) if b not in SHOWN]
    byte = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ids = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(ids[a + b] != 256 + i for i, (a, b) in enumerate(pairs)) or sorted(ids[c] for c in byte) != list(range(256)):
        return None
    special = {t["content"] for t in vocabulary["added_tokens"]}
    return {bytes(byte[c] for c in t): i for t, i in ids.items() if t not in special}


class Encoder:
    """Token ids of whole texts under a vocabulary file of the tokenizers library.

    Plain texts take the same merges by rank, which is several times faster; all others go through the tokenizers library.
    Names of special tokens in a text are ordinary text.
    """

    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary
        ranks = byte_ranks(json.loads(vocabulary))
        self.by_rank = ranks and tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.tokenizer: Tokenizer | None = None

    def _whole(self, text: str) -> list[int]:
        if self.by_rank and plain(text):
            return self.by_rank.encode_ordinary(text)
        if self.tokenizer is None:
            self.tokenizer = Tokenizer.from_str(self.vocabulary)
            self.tokenizer.encode_special_tokens = True
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, texts: list[str], end: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by those of ``end``; number of ids per text)."""
        parts: list[np.ndarray] = []
        n = np.zeros(len(texts), np.int64)
        tail = np.array(end or [], "<u4")
        for i, text in enumerate(texts):
            for one in slices(text):
                parts.append(np.array(self._whole(one), "<u4"))
                n[i] += len(parts[-1])
            parts.append(tail)
            n[i] += len(tail)
        return np.concatenate(parts) if parts else np.zeros(0, "<u4"), n


def piece_lengths(n: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, length) of the pieces of rows with ``n`` ids, in order: whole ones, then the binary digits of the rest."""
    bits = [longest >> k for k in range(1, int(math.log2(longest)) + 1)]
    counts = np.stack([n // longest, *((n & b) > 0 for b in bits)], axis=1).astype(np.int64).ravel()
    lengths = np.tile(np.array([longest, *bits], np.int64), len(n))
    rows = np.repeat(np.arange(len(n)), len(bits) + 1)
    return np.repeat(rows, counts), np.repeat(lengths, counts)


def pack(
    docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text", longest: int = MAX_LENGTH,
    end_id: int = 0,
) -> DataFrame:
    """One row per piece: the id, ``start``, ``length``, ``doc_tokens``, ``tokens`` (little-endian unsigned 32-bit ids),
    ``sequence_id`` and ``offset``.

    ``longest`` is a power of two. A null or empty text has the end id alone. Equal rows and null ids are packed like any other
    rows; an empty table gives no pieces; other columns are not read. Sequence ids are gapless from 0, a bucket (the longest
    first) after the other; their order inside a bucket is that of the tasks that made the pieces. No id is dropped or padded.
    The pieces are written once to the shared folder; only counts per task and length are exchanged.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file: its size is fixed
    key = docs.schema[id_column].dataType
    schema = T.StructType([
        T.StructField("id", key), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("tokens", T.BinaryType()), T.StructField("task", T.IntegerType()),
        T.StructField("nth", T.LongType()),
    ])
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        task = TaskContext.get().partitionId()
        made = np.zeros(longest.bit_length(), np.int64)

        def give(keys: pa.Array, texts: list[str]) -> pa.RecordBatch:
            ids, n = encoder.encode(texts, [end_id])
            row, length = piece_lengths(n, longest)
            ends = np.cumsum(length)
            start = ends - length - (np.cumsum(n) - n)[row]
            bucket = np.array([int(v).bit_length() - 1 for v in (longest >> np.arange(longest.bit_length()))])
            nth = np.empty(len(row), np.int64)
            for b in bucket:
                here = np.flatnonzero(length == 1 << b)
                nth[here] = made[b] + np.arange(len(here))
                made[b] += len(here)
            edges = np.concatenate([[0], ends * 4]).astype(np.int64)
            tokens = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(edges), pa.py_buffer(ids.tobytes())])
            columns = [
                keys.take(pa.array(row)), pa.array(start), pa.array(length), pa.array(n[row]), tokens.cast(arrow.field("tokens").type),
                pa.array(np.full(len(row), task, np.int32)), pa.array(nth),
            ]
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for batch in batches:
            at, held = 0, 0
            texts = batch.column(1)
            waiting: list[str] = []
            for i in range(len(texts)):
                waiting.append(texts[i].as_py() or "")
                held += len(waiting[-1])
                if held >= FLUSH_CHARS or i + 1 == len(texts):
                    yield give(batch.column(0).slice(at, len(waiting)), waiting)
                    at, held, waiting = i + 1, 0, []
        release()

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    pieces = stage(rows.mapInArrow(cut, schema), "pieces")
    tallies = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    totals = {r["length"]: r["n"] for r in tallies.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row per bucket
    base = sum((F.when(F.col("length") < length, n).otherwise(0) for length, n in totals.items()), F.lit(0).cast("long"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = tallies.select("length", "task", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) + base).alias("ahead"))
    return with_small(pieces, ahead, ["length", "task"]).select(
        F.col("id").alias(id_column), "start", "length", "doc_tokens", "tokens", (F.col("ahead") + F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
