"""Preprocessing of every fold's complement from one set of counts.

A fold's training rows are all rows but its own. So a value's count among them is its count over all rows less its count in the
fold, and one pass that counts values per fold gives order statistics, modes and categories of all complements at once. Rows
carry their folds as an array, one entry per repeat; nothing is copied per fold.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.scalars import hash_key
from tallyfold.operators.order import SKETCH_ACCURACY, attach_cuts, hash_cuts, ordered_cumsum
from tallyfold.operators.profile import q
from tallyfold.operators.split import _fold_ranks
from tallyfold.runtime import local_frame, lookup_join

Cell = tuple[int, int]  # (repeat, fold), both from 1
QUARTILES = (0.25, 0.5, 0.75)
GRID = 200  # steps of the sketch that brackets are cut from
EDGES = "column string, e0 double, e1 double, e2 double, e3 double, e4 double, e5 double"


def fold_array(df: DataFrame, keys: list[str], y: str, k: int = 5, repeats: int = 3, seed=42) -> DataFrame:
    """Add ``folds``: the row's fold in each repeat. The folds are those of :func:`split.repeated_folds`; no row is repeated.

    Rows without a class are in no fold and are left out.
    """
    classed = df.where(F.col(y).isNotNull())
    hashes = [hash_key(seed, F.lit(r), *keys) for r in range(1, repeats + 1)]
    rows = classed.select(y, F.posexplode(F.array(*hashes)).alias("repeat", "h"))

    def targets(sizes: DataFrame) -> DataFrame:
        start = F.sum("n").over(Window.partitionBy("repeat").orderBy(y)) - F.col("n")
        return sizes.withColumn("__start", start).withColumn("ranks", _fold_ranks(k, ["repeat"], y))

    cuts = hash_cuts(rows, ["repeat", y], targets)
    by_class = cuts.groupBy(y).agg(F.array_sort(F.collect_list(F.struct("repeat", "cuts"))).alias("cuts"))
    marked = attach_cuts(classed, by_class, [y])
    marked = marked.withColumn("__h", F.array(*hashes))
    folds = F.transform("__h", lambda h, i: F.size(F.filter(F.get("__cuts", i)["cuts"], lambda c: c < h)).cast("int") + 1)
    return marked.withColumn("folds", folds).drop("__cuts", "__h")


def cells_of(k: int, repeats: int) -> list[Cell]:
    return [(r, f) for r in range(1, repeats + 1) for f in range(1, k + 1)]


def _in_cell(cell: Cell):
    return F.col("folds")[cell[0] - 1] == cell[1]


def _wanted_ranks(n: int, missing: int) -> list[int]:
    """Ranks (from 0) among ``n`` values that the median and the quartiles need, after ``missing`` more rows took the median.

    Missing rows stand behind the lower middle value; -1 asks for the median itself.
    """
    half = 0.5 * (n - 1)
    ranks = [math.floor(half), math.ceil(half)]
    before = (n - 1) // 2 + 1
    for p in QUARTILES:
        at = p * (n + missing - 1)
        for rank in (math.floor(at), math.ceil(at)):
            ranks.append(rank if rank < before else -1 if rank < before + missing else rank - missing)
    return ranks


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return local_frame(spark, rows, T._parse_datatype_string(schema))


def _between(low: float, high: float, at: float) -> float:
    return low + (high - low) * (at - math.floor(at))


def complement_quartiles(
    df: DataFrame, cols: list[str], cells: list[Cell], accuracy: int = SKETCH_ACCURACY
) -> dict[Cell, dict[str, tuple[float, list[float]]]]:
    """Per cell and column: the exact median of the complement, and its quartiles once nulls and NaN have become that median.

    ``df`` has ``folds``. Columns without a value in a complement are absent there. Values near the quartiles are counted one by
    one, per cell; a sketch says which these are, and if it was wrong all are counted. What reaches the driver is eight values per
    column and cell.
    """
    if not cols:
        return {c: {} for c in cells}
    long = (
        df.select("folds", *[q(c).cast("double").alias(c) for c in cols])
        .unpivot(["folds"], [q(c) for c in cols], "column", "value")
        .withColumn("value", F.nullif("value", F.lit(float("nan"))))
    )
    known = F.col("value").isNotNull()
    sizes = long.groupBy("column").agg(
        F.count("value").alias("n"), F.count("*").alias("rows"),
        *[F.count(F.when(_in_cell(c) & known, 1)).alias(f"n{i}") for i, c in enumerate(cells)],
        *[F.count(F.when(_in_cell(c), 1)).alias(f"r{i}") for i, c in enumerate(cells)],
        F.percentile_approx("value", [i / GRID for i in range(GRID + 1)], accuracy).alias("grid"),
    )
    found = {r["column"]: r for r in sizes.collect()}
    wanted, brackets = [], []
    for column, r in found.items():
        # A complement strays from all rows like a sample: ten times the error of one, and the sketch's own error.
        slack = 3.0 / accuracy + 10 / math.sqrt(r["n"]) if r["n"] > 5 * accuracy else 1.0
        low, high = [1.0] * 3, [0.0] * 3
        for i in range(len(cells)):
            n = r["n"] - r[f"n{i}"]
            if not n:
                continue
            ranks = _wanted_ranks(n, r["rows"] - r[f"r{i}"] - n)
            wanted += [(column, i, rank) for rank in sorted(set(ranks)) if rank >= 0]
            for j in range(3):
                near = [x / n for x in (ranks[2 * j + 2 : 2 * j + 4] if j != 1 else ranks[:2]) if x >= 0]
                low[j], high[j] = min([low[j], *near]), max([high[j], *near])
        edges: list[float] = []
        for a, b in zip(low, high):
            a, b = math.floor((a - slack) * GRID), math.ceil((b + slack) * GRID)
            edges += [-math.inf if a <= 0 else r["grid"][a], math.inf if b >= GRID else r["grid"][b]]
        brackets.append((column, *edges))
    spark = df.sparkSession
    picked = _pick(long.where(known), _small(spark, brackets, EDGES), cells, wanted)
    if len(picked) < len(wanted):
        opened = [(b[0], *[-math.inf, math.inf] * 3) for b in brackets]
        picked = _pick(long.where(known), _small(spark, opened, EDGES), cells, wanted)
    out: dict[Cell, dict] = {c: {} for c in cells}
    for column, r in found.items():
        for i, cell in enumerate(cells):
            n = r["n"] - r[f"n{i}"]
            if not n:
                continue
            missing = r["rows"] - r[f"r{i}"] - n
            ranks = _wanted_ranks(n, missing)
            low, high = (picked[column, i, rank] for rank in ranks[:2])
            median = _between(low, high, 0.5 * (n - 1))
            values = [median if rank < 0 else picked[column, i, rank] for rank in ranks[2:]]
            quart = [_between(values[2 * j], values[2 * j + 1], p * (n + missing - 1)) for j, p in enumerate(QUARTILES)]
            out[cell][column] = (median, quart)
    return out


def _pick(long: DataFrame, brackets: DataFrame, cells: list[Cell], wanted: list[tuple]) -> dict[tuple[str, int, int], float]:
    """The values at wanted (column, cell, rank)s of the complements; those outside the brackets are absent."""
    inside, gap = F.lit(False), F.lit(0)
    for j in range(3):
        inside = inside | F.col("value").between(F.col(f"e{2 * j}"), F.col(f"e{2 * j + 1}"))
        gap = gap + (F.col("value") > F.col(f"e{2 * j + 1}")).cast("int")
    counts = [f"c{i}" for i in range(len(cells))]
    counted = (
        lookup_join(long, brackets, ["column"], "inner")
        .select("column", "value", "folds", F.when(inside, F.col("value")).alias("kept"), F.when(inside, -1).otherwise(gap).alias("gap"))
        .groupBy("column", "kept", "gap")
        .agg(
            F.count("*").alias("cnt"), F.min("value").alias("at"),
            *[F.count(F.when(_in_cell(c), 1)).alias(name) for c, name in zip(cells, counts)],
        )
    )
    cum = ordered_cumsum(counted, "at", ["cnt", *counts], ["column"])
    ranks: dict[str, list] = {}
    for column, i, rank in wanted:
        ranks.setdefault(column, []).append({"i": i, "rank": rank})
    asked = _small(cum.sparkSession, list(ranks.items()), "column string, wanted array<struct<i:int,rank:bigint>>")
    cum = lookup_join(cum, asked, ["column"], "inner").select(
        "column", "kept", "cnt", "cum_cnt", F.array(*counts).alias("c"), F.array(*[f"cum_{c}" for c in counts]).alias("upto"), "wanted"
    )

    def here(w):
        upto = F.col("cum_cnt") - F.get("upto", w["i"])
        return (w["rank"] < upto) & (w["rank"] >= upto - (F.col("cnt") - F.get("c", w["i"])))

    hits = cum.where("kept IS NOT NULL").select("column", "kept", F.explode(F.filter("wanted", here)).alias("w"))
    return {(r["column"], r["i"], r["rank"]): r["kept"] for r in hits.select("column", "kept", "w.i", "w.rank").collect()}


def complement_hash_cuts(rows: DataFrame, hashes: dict, cells: list[Cell], wanted: list[tuple[str, int, int, int]]) -> dict[tuple[str, int], float]:
    """The hash (a number in [0, 1)) at a rank of a complement: {(name, cell number): hash}, from one count of all cells.

    ``hashes`` maps names to columns, null where a row takes no part; ``wanted`` has (name, cell number, rank from 0, rows of the
    complement that take part). Hashes are spread evenly, so the rank says where to look.
    """
    if not wanted:
        return {}
    entries = F.array(*[F.struct(F.lit(n).alias("column"), h.alias("value")) for n, h in hashes.items()])
    long = rows.select("folds", F.inline(entries)).where("value IS NOT NULL")
    edges: dict[str, list[float]] = {}
    for name, _, rank, n in wanted:
        low, high = rank / n - 10 / math.sqrt(n), (rank + 1) / n + 10 / math.sqrt(n)
        at = edges.setdefault(name, [low, high])
        at[:] = [min(at[0], low), max(at[1], high)]
    asked = [w[:3] for w in wanted]
    picked = _pick(long, _small(rows.sparkSession, [(n, *e * 3) for n, e in edges.items()], EDGES), cells, asked)
    if len(picked) < len(asked):
        picked = _pick(long, _small(rows.sparkSession, [(n, *[-1.0, 2.0] * 3) for n in edges], EDGES), cells, asked)
    return {(name, i): value for (name, i, _), value in picked.items()}


def complement_categories(df: DataFrame, cols: list[str], cells: list[Cell]) -> dict[Cell, dict[str, tuple[str, list[str]]]]:
    """Per cell and column: the mode of the complement, the smallest on ties, and its categories in order.

    One row per category comes to the driver, as the fitted encoders keep them all.
    """
    out: dict[Cell, dict] = {c: {} for c in cells}
    if not cols:
        return out
    long = df.select("folds", *[q(c) for c in cols]).unpivot(["folds"], [q(c) for c in cols], "column", "value").where("value IS NOT NULL")
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"), *[F.count(F.when(_in_cell(c), 1)).alias(f"c{i}") for i, c in enumerate(cells)])
    rows = counts.collect()
    for i, cell in enumerate(cells):
        left: dict[str, list[tuple[int, str]]] = {}
        for r in rows:
            if r["n"] > r[f"c{i}"]:
                left.setdefault(r["column"], []).append((r[f"c{i}"] - r["n"], r["value"]))
        for column, seen in left.items():
            # The order of the encoder: by UTF-16 units, as the strings of the JVM compare.
            out[cell][column] = (min(seen)[1], sorted((v for _, v in seen), key=lambda v: v.encode("utf-16-be")))
    return out


def complement_table(df: DataFrame, nums: list[str], cats: list[str], cells: Iterable[Cell]) -> DataFrame:
    """(repeat, fold, column, median, q1, q3, mode, n_categories): what each fold's training rows fit to."""
    cells = list(cells)
    numbers, categories = complement_quartiles(df, nums, cells), complement_categories(df, cats, cells)
    rows = [(*c, name, m, quart[0], quart[2], None, None) for c in cells for name, (m, quart) in numbers[c].items()]
    rows += [(*c, name, None, None, None, mode, len(seen)) for c in cells for name, (mode, seen) in categories[c].items()]
    return _small(
        df.sparkSession, rows, "repeat int, fold int, column string, median double, q1 double, q3 double, mode string, n_categories int"
    )
