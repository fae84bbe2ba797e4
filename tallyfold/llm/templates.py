"""Benchmark decontamination by template canonicalisation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.parts import BROADCAST_ROWS
from tallyfold.llm.words import LOWER, NOT_ALNUM, mix, range_hashes, split_words, text_slices
from tallyfold.runtime import stage

WINDOW = 8
# A window with fewer words that are no placeholders says too little as a template: it must be found word by word. A character of
# a script without spaces is a token and counts as half a word.
LITERALS = 4
# So many windows of one item, or half of its windows, must be found: six windows of eight words are a run of 13 words.
ENOUGH = 6
ENOUGH_CHARACTERS = 19  # the same of 26 characters, for items most of whose tokens are characters
SHARE = 0.5
FILTER_BITS = 24
UNITS = (
    "kg", "g", "mg", "km", "m", "cm", "mm", "l", "ml", "lb", "lbs", "oz", "ft", "in", "inch", "inches", "feet", "mile", "miles", "meter",
    "meters", "metre", "metres", "liter", "liters", "litre", "litres", "gram", "grams", "second", "seconds", "minute", "minutes", "hour",
    "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "percent", "dollar", "dollars", "euro", "euros", "cent",
    "cents", "degree", "degrees", "mph", "kmh", "hz", "kb", "mb", "gb",
)
_NUMBER, _UNIT, _NAME = (np.uint64(k) for k in (0xA11CE, 0xB0B, 0xCAFE))
# Code points of scripts without spaces (Thai to Tibetan, Burmese, Khmer, kana and Chinese, full-width forms), and of their punctuation.
_UNSPACED = np.array([
    (0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3021, 0x302F), (0x3031, 0x30FA), (0x30FC, 0x312F), (0x31A0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF10, 0xFF19), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF),
])
_MARKS = np.array([(0x3000, 0x3004), (0x3008, 0x3020), (0x3030, 0x3030), (0x30FB, 0x30FB), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65)])
_END_MARK = np.zeros(256, bool)
_END_MARK[list(b".!?:;|")] = True


def _hash_text(words: tuple[str, ...]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    end = np.cumsum([len(w) for w in words])
    return np.sort(range_hashes(data, end - [len(w) for w in words], end))


@dataclass
class Tokens:
    code: np.ndarray  # hash of a word, or its placeholder's code
    value: np.ndarray  # hash of the word itself
    slot: np.ndarray  # whether it is a placeholder
    first: np.ndarray  # first token of each document
    named: np.ndarray  # whether it is a name, or would be one if it did not begin a sentence
    character: np.ndarray  # whether it is a character of a script without spaces


def _within(points: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ranges[:, 0], points, "right") - 1
    return (at >= 0) & (points <= ranges[np.maximum(at, 0), 1])


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the characters of scripts without spaces, and the bytes of their punctuation."""
    lead = np.flatnonzero(data >= 0xE0)
    wide = data[lead] >= 0xF0
    lead, wide = (x[lead + np.where(wide, 4, 3) <= len(data)] for x in (lead, wide))
    b = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) & 0x3F for k in range(4)]
    points = np.where(wide, (b[0] & 7) << 18 | b[1] << 12 | b[2] << 6 | b[3], (b[0] & 15) << 12 | b[1] << 6 | b[2])
    is_char = _within(points, _UNSPACED)
    marks = lead[_within(points, _MARKS)]
    return lead[is_char], lead[is_char] + np.where(wide[is_char], 4, 3), (marks[:, None] + np.arange(3)).ravel()


def canonical(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """Words without outer punctuation, in lower case; numbers, units after numbers, and names become placeholders.

    A number is a word with digits and no letters, or one that starts with a digit ('5kg'). A unit is a unit's word after
    a number. A name is a word with one capital, its first letter, that begins no sentence or line. Words of
    punctuation alone are left out. In scripts without spaces every character is a word.
    """
    begins, ends, marks = _unspaced(data)
    if len(begins) or len(marks):
        data = data.copy()
        data[marks] = 0x20
        words = split_words(data, np.unique(np.concatenate([offsets, begins, ends])), fold=False)
        words.first = np.searchsorted(words.start, offsets)
    else:
        words = split_words(data, offsets, fold=False)
    alnum = np.flatnonzero(~NOT_ALNUM[data])
    lo, hi = np.searchsorted(alnum, words.start), np.searchsorted(alnum, words.end)
    keep = hi > lo
    doc = words.doc()[keep]
    first = np.searchsorted(doc, np.arange(len(offsets)))
    if not keep.any():
        none = np.zeros(0, np.uint64)
        return Tokens(none, none, np.zeros(0, bool), first, np.zeros(0, bool), np.zeros(0, bool))
    start, end = alnum[lo[keep]], alnum[hi[keep] - 1] + 1
    value = range_hashes(LOWER[data], start, end)

    def tally(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int32)
        np.cumsum(mask, out=sums[1:])
        return sums

    digits = tally((data >= 0x30) & (data <= 0x39))
    wide_capital = np.zeros(len(data), bool)  # É and the like: C3 80 .. C3 9E
    wide_capital[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    capital = (data >= 0x41) & (data <= 0x5A) | wide_capital
    capitals = tally(capital)
    letters = tally(~NOT_ALNUM[data] & ~((data >= 0x30) & (data <= 0x39)))
    lines = tally(data == 0x0A)
    n_digits = digits[end] - digits[start]
    number = (n_digits > 0) & (letters[end] == letters[start])
    number |= (data[start] >= 0x30) & (data[start] <= 0x39)
    opens = np.ones(len(start), bool)  # begins a document, a sentence or a line
    before = words.end[keep][:-1]
    opens[1:] = _END_MARK[data[before - 1]] | (lines[start[1:]] > lines[before])
    opens[first[:-1][first[:-1] < len(opens)]] = True
    named = capital[start] & (capitals[end] - capitals[start] == 1) & ~number
    unit = np.zeros(len(start), bool)
    known = np.isin(value[1:], _hash_text(UNITS))
    unit[1:] = known & number[:-1] & (doc[1:] == doc[:-1]) & ~number[1:]
    named &= ~unit
    name = named & ~opens
    code = value.copy()
    code[number], code[unit], code[name] = _NUMBER, _UNIT, _NAME
    return Tokens(code, value, number | unit | name, first, named, np.isin(start, begins))


def windows(tokens: Tokens, size: int, raw: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first token, document) of each window of ``size`` tokens with enough words that are no placeholders; with ``raw``
    placeholders are taken as the words they stand for."""
    total = len(tokens.code)
    none = np.zeros(0, np.int64)
    if total < size:
        return np.zeros(0, np.uint64), none, none
    code, solid = (tokens.value, np.ones(total, bool)) if raw else (tokens.code, ~tokens.slot)
    h = np.full(total - size + 1, size + 64 * raw, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            h = h * np.uint64(0xD1B54A32D192ED03) + code[k : k + total - size + 1]
        h = mix(h)
    doc = np.repeat(np.arange(len(tokens.first) - 1), np.diff(tokens.first))
    halves = np.zeros(total + 1, np.int32)
    np.cumsum(np.where(solid, np.where(tokens.character, 1, 2), 0), out=halves[1:])
    ok = (doc[: total - size + 1] == doc[size - 1 :]) & (halves[size:] - halves[: total - size + 1] >= 2 * LITERALS)
    at = np.flatnonzero(ok)
    return h[at], at, doc[at]


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def _rows(tokens: Tokens, at: np.ndarray, doc: np.ndarray, h: np.ndarray, size: int, raw: bool = False) -> dict[str, pa.Array]:
    """Window hashes, places and slots: the values of the placeholders in each window, with their place in it; raw windows have none."""
    span = at[:, None] + np.arange(size)
    marked = tokens.slot[span] & (not raw)
    ends = np.zeros(len(at) + 1, np.int32)
    np.cumsum(marked.sum(1), out=ends[1:])
    slots = pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens.value[span][marked].view(np.int64)))
    return {"w": pa.array(h.view(np.int64)), "at": pa.array(at - tokens.first[doc]), "slots": slots}


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, n_windows, n_templates, enough, w, item_at, item_slots, size, raw, low) of the items' windows.

    A window with too few words that are no placeholders is ``low`` and hashed as it stands (``raw``). An item's first word
    may begin no sentence in a document: its first window is there twice if that makes the word a name, raw if the
    second is low. An item of fewer than WINDOW tokens is one window; those of less than LITERALS words have none.
    """
    kind = items.schema[id_col].dataType.simpleString()
    schema = f"item_id {kind}, n_windows long, n_templates long, enough long, w long, item_at long, item_slots array<long>, size long, raw boolean, low boolean"
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column(1)):
                tokens = canonical(data, offsets)
                counts = np.diff(tokens.first)
                opening = np.zeros(len(tokens.code), bool)
                opening[tokens.first[:-1][counts > 0]] = True
                opening &= tokens.named
                inside = replace(tokens, code=np.where(opening, _NAME, tokens.code), slot=tokens.slot | opening)
                letters = np.bincount(np.repeat(np.arange(len(counts)), counts)[tokens.character], minlength=len(counts))
                enough = np.where(2 * letters > counts, ENOUGH_CHARACTERS, ENOUGH)
                ids = batch.column(0).slice(row, end - row)
                for size in range(LITERALS, WINDOW + 1):

                    def whole(t: Tokens, raw: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                        h, at, doc = windows(t, size, raw)
                        mine = counts[doc] >= WINDOW if size == WINDOW else counts[doc] == size
                        return h[mine], at[mine], doc[mine]

                    plain, again, raws = whole(tokens, False), whole(inside, False), whole(tokens, True)
                    again = [x[opening[again[1]]] for x in again]
                    low = ~np.isin(raws[1], plain[1])
                    stands = low | opening[raws[1]] & ~np.isin(raws[1], again[1])
                    low, raws = low[stands], [x[stands] for x in raws]
                    n_templates = np.bincount(plain[2], minlength=len(counts))
                    n_windows = n_templates + np.bincount(raws[2][low], minlength=len(counts))
                    for t, (h, at, doc), raw in ((tokens, plain, False), (inside, again, False), (tokens, raws, True)):
                        if len(h):
                            out = _rows(t, at, doc, h, size, raw)
                            flags = [pa.array(np.full(len(h), size)), pa.array(np.full(len(h), raw)), pa.array(low if raw else np.zeros(len(h), bool))]
                            of = [pa.array(x[doc]) for x in (n_windows, n_templates, enough)]
                            yield pa.record_batch([ids.take(pa.array(doc)), *of, out["w"], out["at"], out["slots"], *flags], names)

    return items.select(id_col, text_col).mapInArrow(run, schema)


def consistent_windows(spans: list) -> tuple[list[int], list[int], int] | None:
    """(places, those of templates, changed slots) of an alignment's windows that lie in stretches with consistent slots.

    ``spans`` has (item_at, low, [(item's value, document's value), ...]) per window. A stretch ends where the next window is
    missing, and before the first window that contradicts it; a window that contradicts itself is in none.
    """
    if spans is None:
        return None
    ats, sure, changed = set(), set(), set()
    there, back, last = {}, {}, None

    def fits(pairs: list) -> bool:
        x, y = dict(there), dict(back)
        return all(x.setdefault(i, d) == d and y.setdefault(d, i) == i for i, d in pairs)

    for at, low, pairs in sorted((at, low, sorted(tuple(p) for p in pairs)) for at, low, pairs in spans):
        if last is not None and at > last + 1:
            there, back = {}, {}
        last = at
        if not fits(pairs):
            there, back = {}, {}
            if not fits(pairs):
                continue
        there.update(pairs)
        back.update((d, i) for i, d in pairs)
        ats.add(at)
        if not low:
            sure.add(at)
        changed.update(p for p in pairs if p[0] != p[1])
    return sorted(ats), sorted(sure), len(changed)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Documents that hold an item, word by word or with other numbers, names and units: one row per document and item.

    Columns: doc_id, text_hash (xxhash64 of the text), item_id, n_found (distinct windows of the item found), n_windows
    (those it has), n_changed (slots whose value differs). An item is found by enough of all its windows, or of those that
    are templates. A stretch of windows that follow each other in both texts
    counts if its slots are consistent: equal values stand where equal values stood, and different ones where
    different ones did; a contradiction ends a stretch, and the windows before and after it still count. Null or empty texts and items match nothing; ids may be null or repeated; extra columns are
    not read. Windows of documents first meet a bit table of fixed size, which lets through those of the items and a few
    more; the rest is an equi-join, broadcast while the items are few and by shuffle beyond BROADCAST_ROWS.
    """
    spark = docs.sparkSession
    index = stage(item_windows(items, item_col), "template")
    n_index = index.count()
    table = np.zeros((2, 1 << (FILTER_BITS - 3)), np.uint8)
    folded = index.select(F.col("w").bitwiseAND((1 << FILTER_BITS) - 1).alias("b"), F.lit(0).alias("k")).union(
        index.select(F.shiftrightunsigned("w", 32).bitwiseAND((1 << FILTER_BITS) - 1), F.lit(1))
    )
    bits = folded.distinct().toArrow()  # at most two times 2 ** FILTER_BITS numbers
    b, k = bits["b"].to_numpy(), bits["k"].to_numpy()
    np.bitwise_or.at(table, (k, b >> 3), (1 << (b & 7)).astype(np.uint8))
    kinds = sorted((r["size"], r["raw"]) for r in index.select("size", "raw").distinct().collect())  # sizes from LITERALS to WINDOW
    shared = spark.sparkContext.broadcast(table)
    kind = docs.schema[id_col].dataType.simpleString()

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column(2)):
                tokens = canonical(data, offsets)
                for size, raw in kinds:
                    h, at, doc = windows(tokens, size, raw)
                    x, y = _bits(h)
                    hit = (known[0][x >> 3] >> (x & 7) & 1).astype(bool) & (known[1][y >> 3] >> (y & 7) & 1).astype(bool)
                    if not hit.any():
                        continue
                    h, at, doc = h[hit], at[hit], doc[hit]
                    out = _rows(tokens, at, doc, h, size, raw)
                    part = batch.slice(row, end - row).take(pa.array(doc))
                    yield pa.record_batch(
                        [part.column(0), part.column(1), out["w"], out["at"], out["slots"]], ["doc_id", "text_hash", "w", "doc_at", "doc_slots"]
                    )

    found = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("t")).mapInArrow(
        probe, f"doc_id {kind}, text_hash long, w long, doc_at long, doc_slots array<long>"
    )
    hits = found.join(F.broadcast(index) if n_index <= BROADCAST_ROWS else index, "w")
    hits = hits.where("size(doc_slots) = size(item_slots)").withColumn("shift", F.col("doc_at") - F.col("item_at"))
    pairs = F.arrays_zip(F.col("item_slots").alias("i"), F.col("doc_slots").alias("d"))
    of = ["doc_id", "text_hash", "item_id", "n_windows", "n_templates", "enough"]
    kept = "struct<ats: array<long>, sure: array<long>, changed: int>"
    spans = hits.groupBy(*of, "shift").agg(F.collect_set(F.struct("item_at", "low", pairs.alias("pairs"))).alias("spans"))
    # An alignment has as many windows as the item at most.
    spans = spans.withColumn("pairs", F.array_distinct(F.flatten(F.transform("spans", lambda w: w["pairs"]))))
    one_to_one = (F.size(F.array_distinct(F.transform("pairs", lambda p: p["i"]))) == F.size("pairs")) & (
        F.size(F.array_distinct(F.transform("pairs", lambda p: p["d"]))) == F.size("pairs")
    )
    every = F.struct(
        F.transform("spans", lambda w: w["item_at"]).alias("ats"),
        F.transform(F.filter("spans", lambda w: ~w["low"]), lambda w: w["item_at"]).alias("sure"),
        F.size(F.filter("pairs", lambda p: p["i"] != p["d"])).alias("changed"),
    ).cast(kept)
    # Most alignments are consistent as a whole; only the others are cut into stretches, window by window.
    cut = F.udf(consistent_windows, kept)(F.when(~one_to_one, F.col("spans")))
    good = spans.select(*of, F.coalesce(cut, every).alias("kept")).select(*of, "kept.*").where(F.size("ats") > 0)
    distinct = lambda name: F.size(F.array_distinct(F.flatten(F.collect_set(name)))).cast("long")
    per_item = good.groupBy(*of).agg(distinct("ats").alias("n_found"), distinct("sure").alias("n_sure"), F.min("changed").alias("n_changed"))
    need = lambda n: F.least("enough", F.ceil(F.col(n) * SHARE))
    found = (F.col("n_found") >= need("n_windows")) | (F.col("n_templates") > 0) & (F.col("n_sure") >= need("n_templates"))
    return per_item.where(found).drop("n_templates", "enough", "n_sure")
