"""N-gram Jaccard join by PartEnum signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.parts import components, with_small
from tallyfold.llm.words import mix, release, shingle_sets, split_words, text_slices
from tallyfold.runtime import stage

# Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 75
# First-level partitions per level, as a multiple of the fewest that leave one of two linked sets' with at most one difference;
# on the last level every element stands alone.
LEVELS = (1.2, 2.0, 4.0)
# Schemes of at most so many differences (sets up to 126) cut a first-level partition into three and enumerate its three pairs of
# second-level partitions; the others cut it into two and enumerate these, which takes a third less signatures.
TRIPLE_DIFFERENCES = 36
# A run is the sets that share one signature. Up to this many members it is compared pairwise, beyond by pivots.
SHORT_RUN = 12
# Signatures that one exchange partition should hold, and that a task holds before it passes them on.
PARTITION_SIGNATURES = 1_500_000
FLUSH = 1_000_000
# Packed arrays per exchange partition: several small ones each, so that partitions are of near equal size.
PIECES = 8
LONG_ROW = 10_000
# Sets of a family that one task compares with as many others.
BLOCK = 2_000
# A signature's last bits name its scheme: size band and level. So many of its other bits are exchanged, beside its bucket.
SCHEME_BITS = 10
HASH_BITS = 30
# Bytes of an exchanged signature, and of the number that stands for a set beside it: the first half of its id.
SIGNATURE_BYTES = (SCHEME_BITS + HASH_BITS) // 8
NUMBER_BYTES = 4
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def size_bands(largest: int, percent: int = PERCENT) -> np.ndarray:
    """Upper ends of the size bands: a set links only with sets of its own band and of the two beside it."""
    ends = [1]
    while ends[-1] < largest:
        ends.append(max(ends[-1] + 1, ends[-1] * 100 // percent))
    return np.array(ends)


def most_differences(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Largest symmetric difference of two linked sets of at most ``size`` elements each: (a + b) (1 - t) / (1 + t)."""
    return 2 * size * (100 - percent) // (100 + percent)


def most_lost(k: np.ndarray, n1: np.ndarray, n2: int) -> np.ndarray:
    """Most signatures of a set that ``k`` differences can spoil, with ``n1`` first-level partitions cut into ``n2`` each.

    Of three pairs a first difference spoils two and another the third; of two single partitions each spoils one.
    """
    return 2 * np.minimum(k, n1) + np.maximum(0, k - n1) if n2 == 3 else k


def _enumerate(sums: np.ndarray, part: np.ndarray, d: np.ndarray, n2: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) of every subset of n2 - 1 second-level partitions of a first-level one that has elements.

    ``sums`` are those of the elements that a set has in a second-level partition, in the order of sets and partitions.
    """
    if n2 == 2:
        return sums + part * _SEEDS[0], d
    outer, inner = part // np.uint64(n2), (part % np.uint64(n2)).astype(np.int64)
    new = np.ones(len(d), bool)
    new[1:] = (outer[1:] != outer[:-1]) | (d[1:] != d[:-1])
    at, group = np.flatnonzero(new), np.cumsum(new) - 1
    inside, present = np.zeros((len(at), n2), np.uint64), np.zeros((len(at), n2), bool)
    inside[group, inner], present[group, inner] = sums, True
    without = inside.sum(1)[:, None] - inside
    label = (outer[at] * np.uint64(n2))[:, None] + np.arange(n2, dtype=np.uint64)
    some = present.sum(1)[:, None] > present
    return (without + label * _SEEDS[0])[some], np.broadcast_to(d[at][:, None], some.shape)[some]


def signatures(h: np.ndarray, first: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(signature, set, spares) of sorted 64-bit sets ``h[first[i]:first[i + 1]]``.

    Sets are compared within the scheme of the larger one's size band. Two linked sets of a scheme differ in at most k
    elements. Elements are dealt by their hash into n1 > k / 2 first-level partitions, so two linked sets differ in at most
    one element somewhere; each is cut into n2 second-level partitions, and what a set has in n2 - 1 of them is one
    signature, for every such subset. Subsets without elements are no signatures, so a set is done with a level only if it
    has more of them than its differences to any set it may link with can spoil: then one that both share is among
    them. Otherwise it takes part in the next level as well, with more partitions; on the last one every element stands
    alone. Of a linked pair, the set that is done first is found at its level, since the other one has signatures there
    too.

    ``spares`` lists (set, scheme, spare) for the levels that sets are done with: so many of the set's signatures there
    may be left out, and the rest still holds one that it shares with each set it links with.
    """
    sizes = np.diff(first)
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), []
    ends = size_bands(int(sizes.max()) * 100 // percent + 1, percent)
    own = np.searchsorted(ends, sizes)
    out_s, out_d, spares = [], [], []
    scheme_mask = np.uint64((1 << SCHEME_BITS) - 1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    mixed = mix(h)
    top = (h >> np.uint64(32)).astype(np.uint64)
    for step in range(3):
        band = np.minimum(own + step, len(ends) - 1)
        low = np.where(band > 0, ends[np.maximum(band - 1, 0)] + 1, 1)
        part_of = (sizes > 0) & (sizes * 100 >= low * percent) & (own + step < len(ends))
        k = most_differences(ends[band], percent)
        # The set itself differs less from those it may link with here, if it is small for the band.
        k_own = (sizes + np.minimum(ends[band], sizes * 100 // percent)) * (100 - percent) // (100 + percent)
        for n2 in (2, 3):
            todo = np.flatnonzero(part_of & ((k <= TRIPLE_DIFFERENCES) == (n2 == 3)))
            for level in range(len(LEVELS) + 1):
                if not len(todo):
                    break
                chosen = np.zeros(len(sizes), bool)
                chosen[todo] = True
                el = np.flatnonzero(chosen[owner])
                d = owner[el]
                with np.errstate(over="ignore"):
                    if level < len(LEVELS):
                        n1 = np.ceil((k + 1) * LEVELS[level] / 2).astype(np.int64)
                        n = (n1 * n2).astype(np.uint64)
                        part = (top[el] * n[d]) >> np.uint64(32)
                        new = np.ones(len(el), bool)
                        new[1:] = (part[1:] != part[:-1]) | (d[1:] != d[:-1])
                        at = np.flatnonzero(new)
                        s, d = _enumerate(np.add.reduceat(mixed[el], at), part[at], d[at], n2)
                        lost = most_lost(k_own, n1, n2)
                    else:
                        s, lost = mixed[el], k_own
                    scheme = (band[d] * 4 + level).astype(np.uint64)
                    s = mix(s + scheme * _SEEDS[1]) & ~scheme_mask | scheme
                out_s.append(s)
                out_d.append(d)
                full = np.bincount(d, minlength=len(sizes))
                done = full[todo] > lost[todo]
                ready = todo[done]
                spares.append((ready, band[ready] * 4 + level, full[ready] - lost[ready] - 1))
                todo = todo[~done]
    return np.concatenate(out_s), np.concatenate(out_d), spares


def parity_sketches(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, first byte per set): bit i is the parity of the number of elements whose last bits are i.

    The number of bits that differ between two sketches is at most the number of elements that the sets differ in. There is
    at least one bit an element.
    """
    sizes = np.diff(first)
    bits = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(1, sizes))).astype(np.int64))
    base = np.concatenate([[0], np.cumsum(bits)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = base[owner] + (h & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    parity = (np.bincount(at, minlength=base[-1]) & 1).astype(np.uint8)
    return np.packbits(parity), base // 8


def difference_bound(x: bytes, y: bytes) -> int:
    """A lower bound of the number of elements that two sets differ in, from their sketches."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    n = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(v.reshape(-1, n), axis=0) if len(v) > n else v for v in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def _sets(batch: pa.RecordBatch, column: int, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, elements, first element per document, set id): the id is a hash of the whole set, 0 for none."""
    for row, end, data, offsets in text_slices(batch.column(column)):
        h, first = shingle_sets(split_words(data, offsets), n)
        sums = np.zeros(len(h) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(mix(h), out=sums[1:])
            size = np.diff(first).astype(np.uint64)
            sid = mix(sums[first[1:]] - sums[first[:-1]] + size * _SEEDS[3])
        sid[size == 0] = 0
        yield row, end, h, first, sid


def _subset(h: np.ndarray, first: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(first)[keep]
    mask = np.zeros(len(first) - 1, bool)
    mask[keep] = True
    return h[np.repeat(mask, np.diff(first))], np.concatenate([[0], np.cumsum(sizes)])


def describe_sets(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """One row per document: (doc_id, text_key, n_shingles, sid, spares, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, h, first, sid in _sets(batch, 2, n):
                docs_here = end - row
                who, scheme, spare = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in zip(*signatures(h, first)[2])) if len(h) else (np.zeros(0, np.int64),) * 3
                order = np.argsort(who, kind="stable")
                ends = np.searchsorted(who[order], np.arange(docs_here + 1))
                items = pa.StructArray.from_arrays([pa.array(scheme[order].astype(np.int32)), pa.array(spare[order].astype(np.int32))], ["scheme", "spare"])
                data, at = parity_sketches(h, first)
                sketch = pa.Array.from_buffers(pa.binary(), docs_here, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])
                part = batch.slice(row, docs_here)
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(np.diff(first)), pa.array(sid.view(np.int64)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items), sketch],
                    ["doc_id", "text_key", "n_shingles", "sid", "spares", "sketch"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("t")).mapInArrow(
        run, f"doc_id {kind}, text_key long, n_shingles long, sid long, spares array<struct<scheme:int,spare:int>>, sketch binary"
    )


def signature_runs(docs: DataFrame, text_col: str, n: int, parts: int) -> DataFrame:
    """(signature, members, sets): the numbers of the sets of each signature that sets of at least two numbers have.

    A run of at most SHORT_RUN sets is one row, and rows with the same sets are not repeated; a longer one is as many rows as
    it needs.

    Signatures are exchanged as packed arrays, one per bucket and flush, without rows: five bytes of the signature, which
    its bucket completes, and four for the set. Copies have the same number and count once. Different sets of one number are
    told apart when numbers become set ids, and different signatures that look alike only bring sets together that are
    then compared.
    """

    buckets = parts * PIECES
    width = SIGNATURE_BYTES + NUMBER_BYTES

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def flush() -> pa.RecordBatch:
            s, d = (np.concatenate(v) for v in zip(*held))
            held.clear()
            bucket = (mix(s) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket.astype(np.uint16) if buckets < 65536 else bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(ends))
            scheme = s & np.uint64((1 << SCHEME_BITS) - 1)
            short = (s >> np.uint64(64 - HASH_BITS) << np.uint64(SCHEME_BITS)) | scheme
            packed = np.empty((len(s), width), np.uint8)
            packed[:, :SIGNATURE_BYTES] = short[order].view(np.uint8).reshape(-1, 8)[:, :SIGNATURE_BYTES]
            packed[:, SIGNATURE_BYTES:] = d[order].view(np.uint8).reshape(-1, NUMBER_BYTES)
            at = pa.py_buffer((np.append(ends[full], ends[-1]) * width).astype(np.int32))
            return pa.record_batch([pa.array(full), pa.Array.from_buffers(pa.binary(), len(full), [None, at, pa.py_buffer(packed)])], ["bucket", "packed"])

        for batch in batches:
            for _, _, h, first, sid in _sets(batch, 0, n):
                _, keep = np.unique(sid, return_index=True)
                keep = np.sort(keep[sid[keep] != 0])
                if not len(keep):
                    continue
                s, d, _ = signatures(*_subset(h, first, keep))
                held.append((s, (sid[keep] >> np.uint64(32)).astype(np.uint32)[d]))
                count += len(s)
                if count >= FLUSH:
                    yield flush()
                    count = 0
        if count:
            yield flush()
        release()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                pieces.setdefault(bucket, []).append(np.frombuffer(packed.as_buffer(), np.uint8).reshape(-1, width))
        passed = np.zeros(0, np.uint64)  # hashes of the short lists of members so far
        while pieces:  # a signature's members are all in one bucket, and one bucket at a time is unpacked
            bucket, parts = pieces.popitem()
            both = np.concatenate(parts)
            wide = np.zeros((len(both), 8), np.uint8)
            wide[:, :SIGNATURE_BYTES] = both[:, :SIGNATURE_BYTES]
            s = wide.view(np.uint64)[:, 0] | np.uint64(bucket) << np.uint64(8 * SIGNATURE_BYTES)
            d = both[:, SIGNATURE_BYTES:].copy().view(np.uint32)[:, 0].astype(np.uint64)
            del parts, both, wide
            order = np.lexsort((d, s))
            s, d = s[order], d[order]
            new = np.ones(len(s), bool)
            new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
            s, d = s[new], d[new]
            at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            size = np.diff(np.append(at, len(s)))
            short = np.flatnonzero((size > 1) & (size <= SHORT_RUN))
            with np.errstate(over="ignore"):  # near copies share many signatures: each short list of members is passed on once
                lists = np.add.reduceat(mix(d), at)[short]
            lists, first = np.unique(lists, return_index=True)
            fresh = ~np.isin(lists, passed)
            passed = np.concatenate([passed, lists[fresh]])
            short = short[first[fresh]]
            yield from rows(s, d, at[short], size[short])
            chunks = [(k, lo) for k in np.flatnonzero(size > SHORT_RUN) for lo in range(0, size[k], LONG_ROW)]
            if chunks:
                k, lo = np.array(chunks).T
                yield from rows(s, d, at[k] + lo, np.minimum(size[k] - lo, LONG_ROW), size[k])
        release()

    def rows(s: np.ndarray, d: np.ndarray, at: np.ndarray, n: np.ndarray, members: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        members = n if members is None else members
        for i in range(0, len(at), 20_000):
            a, m = at[i : i + 20_000], n[i : i + 20_000]
            ends = np.concatenate([[0], np.cumsum(m)])
            picked = d[np.repeat(a - ends[:-1], m) + np.arange(ends[-1])]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(picked.view(np.int64)))
            yield pa.record_batch([pa.array(s[a].view(np.int64)), pa.array(members[i : i + 20_000]), lists], ["signature", "members", "sets"])

    packed = docs.select(text_col).mapInArrow(pack, "bucket long, packed binary")
    return packed.repartition(parts, "bucket").mapInArrow(meet, "signature long, members long, sets array<long>")


def short_run_pairs(runs: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b, of the numbers of sets in runs of at most SHORT_RUN members."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            at, size = lists.offsets.to_numpy()[:-1], np.diff(lists.offsets.to_numpy())
            flat = lists.values.to_numpy()
            found = [np.zeros((0, 2), np.int64)]
            for m in range(2, SHORT_RUN + 1):
                sets = flat[at[size == m][:, None] + np.arange(m)]
                i, j = np.triu_indices(m, 1)
                found.append(np.stack([sets[:, i].ravel(), sets[:, j].ravel()], 1))
            both = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
            yield pa.record_batch([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    return runs.where(F.col("members") <= SHORT_RUN).select("sets").mapInArrow(pairs, "a long, b long").distinct()


def long_runs(runs: DataFrame, sets: DataFrame) -> DataFrame:
    """(signature, sid) of the longer runs, without the sets that can spare all of theirs.

    A passage that many documents hold makes long runs of sets that have little else in common. A set with at most as many
    signatures in long runs as it may leave out (by scheme) still meets all its links in short runs, so it leaves.
    """
    longer = runs.where(F.col("members") > SHORT_RUN).select("signature", F.explode("sets").alias("number"))
    longer = longer.join(sets.select("number", "sid"), "number").select(
        "signature", "sid", F.col("signature").bitwiseAND((1 << SCHEME_BITS) - 1).cast("int").alias("scheme")
    )
    counts = longer.groupBy("sid", "scheme").agg(F.count("*").alias("used"))
    of_scheme = F.filter("spares", lambda s: s["scheme"] == F.col("scheme"))
    spare = F.coalesce(F.try_element_at(of_scheme, F.lit(1))["spare"], F.lit(-1))
    bound = counts.join(sets.select("sid", "spares"), "sid").where(F.col("used") > spare).select("sid", "scheme")
    return longer.join(bound, ["sid", "scheme"]).select("signature", "sid")


def with_ids(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of set ids for pairs of numbers, and the pairs of different sets that have the same number."""
    one = lambda number, sid: sets.select(F.col("number").alias(number), F.col("sid").alias(sid))
    met = pairs.join(one("a", "x"), "a").join(one("b", "y"), "b")
    alike = one("a", "x").join(one("a", "y"), "a").where("x < y")
    return met.select("x", "y").union(alike.select("x", "y"))


def judge(pairs: DataFrame, sketches: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, maybe) of pairs of sets: whether their sketches leave a link possible."""
    one = lambda side: sketches.select(F.col("sid").alias(side), F.col("size").alias(f"n_{side}"), F.col("sketch").alias(f"k_{side}"))
    sized = pairs.join(one("a"), "a").join(one("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(2).to_numpy() + batch.column(4).to_numpy()
            bound = np.array([difference_bound(x.as_py(), y.as_py()) for x, y in zip(batch.column(3), batch.column(5))], np.int64)
            bound = np.maximum(bound, np.abs(batch.column(2).to_numpy() - batch.column(4).to_numpy()))
            maybe = 100 * (size - bound) >= percent * (size + bound)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(maybe)], ["a", "b", "maybe"])

    return sized.select("a", "b", "n_a", "k_a", "n_b", "k_b").mapInArrow(run, "a long, b long, maybe boolean")


def verify(pairs: DataFrame, docs: DataFrame, keys: DataFrame, text_col: str, n: int, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets, which are made again from the texts of the documents concerned."""
    wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    texts = wanted.join(keys, "sid").select("text_key").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, h, first, sid in _sets(batch, 0, n):
                _, keep = np.unique(sid, return_index=True)
                keep = np.sort(keep[sid[keep] != 0])
                h, first = _subset(h, first, keep)
                body = pa.Array.from_buffers(pa.binary(), len(keep), [None, pa.py_buffer((first * 8).astype(np.int32)), pa.py_buffer(h)])
                yield pa.record_batch([pa.array(sid[keep].view(np.int64)), body], ["sid", "body"])

    chosen = with_small(docs.select(F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("t")), texts, ["text_key"], "left_semi")
    sets = chosen.select("t").mapInArrow(run, "sid long, body binary").groupBy("sid").agg(F.first("body").alias("body"))
    sets = stage(sets, "sets")
    both = pairs.join(sets.select(F.col("sid").alias("a"), F.col("body").alias("x")), "a").join(sets.select(F.col("sid").alias("b"), F.col("body").alias("y")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked[i] = 100 * common >= percent * (len(x) + len(y) - common)
            mask = pa.array(linked)
            yield pa.record_batch([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_key, first) of every document; ``first`` marks the one that stands for its component.

    Documents are sets of ``n``-word shingles (words of a null or empty text: none, and it links with nothing; fewer
    than ``n`` words are one shingle). Two documents link when their Jaccard similarity is at least 0.75. component_id is
    the smallest id among the documents that links reach; a null id is passed over while there is another. Equal sets
    are one node, so a group of copies costs one set. Shingles are 64-bit hashes. Repeated rows are rows of their own;
    other columns are not read.

    Links between different sets: pairs of short runs are all compared. In long runs (see ``long_runs``) every member is
    compared with the run's pivot, the one that meets most others. Members that do not link with it are compared with
    those of other components. Each comparison is first a parity sketch, which is exact in what it rejects, then the
    whole sets.
    """
    described = stage(describe_sets(docs, id_col, text_col, n), "partenum")
    total = described.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    parts = max(8, int(total // PARTITION_SIGNATURES) + 1)
    runs = stage(signature_runs(docs, text_col, n, parts), "partenum")
    some = described.where("sid <> 0")
    firsts = (F.first(c).alias(a) for c, a in (("n_shingles", "size"), ("sketch", "sketch"), ("spares", "spares")))
    sketches = some.groupBy("sid").agg(*firsts, F.min("text_key").alias("text_key")).withColumn("number", F.shiftrightunsigned("sid", 32))
    sketches = stage(sketches, "partenum")
    keys = sketches.select("sid", "text_key")
    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))

    longer = stage(long_runs(runs, sketches), "partenum")
    # The member that meets most others in long runs is closest to the middle of its family.
    central = longer.join(longer.groupBy("signature").agg(F.count("*").alias("n")), "signature").groupBy("sid").agg(F.sum("n").alias("met"))
    pivots = stage(longer.join(central, "sid").groupBy("signature").agg(F.max_by("sid", F.struct("met", "sid")).alias("pivot")), "partenum")
    stars = longer.join(pivots, "signature").where("sid <> pivot")
    pairs = with_ids(short_run_pairs(runs), sketches).select(*ordered("x", "y")).union(stars.select(*ordered("sid", "pivot"))).distinct()
    judged = stage(judge(pairs, sketches), "partenum")
    links = stage(verify(judged.where("maybe").select("a", "b"), docs, keys, text_col, n), "partenum")
    if stars.limit(1).count():
        links = stage(links.union(_rest_of_long_runs(longer, pivots, judged, links, sketches, docs, keys, text_col, n)).distinct(), "partenum")
    found = components(links)

    owners = described.select("doc_id", "text_key", "n_shingles", "sid").join(
        found.select(F.col("node").alias("sid"), F.col("component").alias("root")), "sid", "left"
    )
    # A set that nothing else links with is its own root; a document without a set is its own component.
    root = F.when(F.col("sid") != 0, F.coalesce("root", "sid"))
    # Null ids come last; of rows that share the smallest id, the first by text hash stands for the component.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    smallest = owners.withColumn("root", root).groupBy("root").agg(F.min(order).alias("least"))
    out = owners.withColumn("root", root).join(smallest, "root", "left")
    alone = F.col("root").isNull()
    return out.select(
        "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"), "text_key",
        (alone | F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_key") == F.col("least.text_key"))).alias("first"),
    )


def _rest_of_long_runs(longer, pivots, judged, links, sketches, docs, keys, text_col, n) -> DataFrame:
    """Links between members of long runs that their pivots have not brought together.

    The members of all runs of one pivot are a family. Sets that do not link with the pivot meet the members of other
    components by blocks of BLOCK sets each way; a block compares sketches and passes on the pairs they leave possible.
    """
    found = components(links)
    family = stage(longer.join(pivots, "signature").where("sid <> pivot").select("pivot", "sid").distinct(), "partenum")
    placed = family.join(found, family["sid"] == found["node"], "left").select("pivot", "sid", F.coalesce("component", "sid").alias("comp"))
    linked = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).select(F.col("a").alias("pivot"), F.col("b").alias("sid"), F.lit(True).alias("linked"))
    placed = stage(placed.join(linked, ["pivot", "sid"], "left").join(sketches.select("sid", "size", "sketch"), "sid"), "partenum")
    counts = placed.groupBy("pivot").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    rows = placed.join(counts.select("pivot", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "pivot")
    mine = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = rows.where("linked IS NULL").select("pivot", mine.alias("i"), every.alias("j"), "sid", "comp", "size", "sketch")
    right = rows.select(F.col("pivot").alias("p"), every.alias("ri"), mine.alias("rj"), *(F.col(c).alias(f"r_{c}") for c in ("sid", "comp", "size", "sketch")))
    left = left.toDF("p", "li", "lj", *left.columns[3:])

    def meet(key: tuple, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((0, 2), np.int64)]
        y = y.rename(columns=lambda c: c.removeprefix("r_"))
        by_length = lambda df: [(n, g) for n, g in df.groupby(df["sketch"].map(len))] if len(df) else []
        for nx, gx in by_length(x):
            for ny, gy in by_length(y):
                width = min(nx, ny)
                fold = lambda g, n: np.bitwise_xor.reduce(np.frombuffer(b"".join(g["sketch"]), np.uint8).reshape(len(g), n // width, width), axis=1)  # noqa: E731, B023
                a, b = fold(gx, nx), fold(gy, ny)
                sa, sb, sy, cy = gx["size"].to_numpy(), gy["size"].to_numpy(), gy["sid"].to_numpy(), gy["comp"].to_numpy()
                step = max(1, (8 << 20) // max(1, width * len(b)))
                for lo in range(0, len(a), step):
                    part = slice(lo, lo + step)
                    bound = np.bitwise_count(a[part][:, None] ^ b[None]).sum(2, dtype=np.int64)
                    size = sa[part][:, None] + sb[None]
                    ok = (100 * (size - bound) >= PERCENT * (size + bound)) & (gx["comp"].to_numpy()[part][:, None] != cy[None])
                    i, k = np.nonzero(ok)
                    out.append(np.stack([gx["sid"].to_numpy()[part][i], sy[k]], 1))
        both = np.unique(np.sort(np.concatenate(out), axis=1), axis=0)
        return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})

    pairs = left.groupBy("p", "li", "lj").cogroup(right.groupBy("p", "ri", "rj")).applyInPandas(meet, "a long, b long").distinct()
    more = stage(pairs.join(judged.select("a", "b"), ["a", "b"], "left_anti"), "partenum")
    return verify(more, docs, keys, text_col, n)
