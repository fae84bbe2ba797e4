"""Stratified splits, folds and nested subsets in a deterministic hash order.

Every assignment is a comparison of ``md5(seed|key)`` with a few cut values per stratum
(:func:`tallyfold.operators.order.hash_cuts`), so the data itself is never shuffled or sorted.
Keys must be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.scalars import hash_key
from tallyfold.operators.order import attach_cuts, hash_cuts, passed_cuts


def train_counts(sizes: DataFrame, strata: list[str], test_size: float) -> DataFrame:
    """Training rows per stratum: ceil(test_size * n) rows go to test, the rest is shared out by
    largest remainder, the first stratum winning ties."""
    everything = Window.partitionBy()  # one row per stratum
    total = F.sum("n").over(everything)
    n_train = total - F.ceil(F.lit(test_size) * total)
    exact = n_train * F.col("n") / total
    left = F.round(exact - F.floor(exact), 9)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("__left"), *strata))
    return (
        sizes.withColumns({"__train": n_train, "__floor": F.floor(exact), "__left": left})
        .withColumn("__need", F.col("__train") - F.sum("__floor").over(everything))
        .withColumn("take", (F.col("__floor") + (place <= F.col("__need")).cast("long")).cast("long"))
        .select(*strata, "n", "take")
    )


def stratified_split(df: DataFrame, keys: list[str], y: str, test_size: float = 0.5, seed=42) -> DataFrame:
    """Add ``split`` = 'train' or 'test', class shares kept.

    Rows without a class go to 'test' and take no part in the shares.
    """
    h = hash_key(seed, *keys)
    cuts = hash_cuts(
        df.where(F.col(y).isNotNull()).select(y, h.alias("h")),
        [y],
        lambda sizes: train_counts(sizes, [y], test_size).withColumn("ranks", F.array("take")),
    )
    marked = attach_cuts(df.withColumn("__h", h), cuts.drop("n"), [y])
    return marked.withColumn("split", F.when(F.col("__h") <= F.col("__cuts")[0], "train").otherwise("test")).drop("__h", "__cuts")


def split_report(df: DataFrame, y: str = "y", split: str = "split") -> DataFrame:
    """(split, y, n, share) per side."""
    counts = df.groupBy(split, y).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(split)))


def _fold_ranks(k: int, strata: list[str], y: str) -> Column:
    """Last rank of folds 1..k-1 inside a class.

    Fold sizes follow dealing the class-sorted rows out like cards, so they differ by at most one
    inside a class and overall.
    """
    start = F.col("__start")
    stop = start + F.col("n")

    def dealt(i: int) -> Column:  # positions p in [start, stop) with p % k == i
        return F.floor((stop - F.lit(i) + (k - 1)) / k) - F.floor((start - F.lit(i) + (k - 1)) / k)

    sums, acc = [], F.lit(0)
    for i in range(k - 1):
        acc = acc + dealt(i)
        sums.append(acc.cast("long"))
    return F.array(*sums) if sums else F.array().cast("array<bigint>")


def repeated_folds(df: DataFrame, keys: list[str], y: str, k: int = 5, repeats: int = 3, seed=42) -> DataFrame:
    """Rows times repeats with ``repeat`` and ``fold`` (both from 1); folds are disjoint and stratified.

    Rows without a class are in no fold and are left out.
    """
    exploded = df.where(F.col(y).isNotNull()).withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    h = hash_key(seed, "repeat", *keys)

    def targets(sizes: DataFrame) -> DataFrame:
        start = F.sum("n").over(Window.partitionBy("repeat").orderBy(y)) - F.col("n")
        return sizes.withColumn("__start", start).withColumn("ranks", _fold_ranks(k, ["repeat"], y))

    cuts = hash_cuts(exploded.select("repeat", y, h.alias("h")), ["repeat", y], targets)
    marked = attach_cuts(exploded.withColumn("__h", h), cuts.drop("n"), ["repeat", y])
    return marked.withColumn("fold", passed_cuts("__h") + 1).drop("__h", "__cuts")


def fold_position(split_index, k: int) -> tuple[Column, Column]:
    """(repeat, fold) of a running split number, all from 1."""
    i = F.col(split_index) if isinstance(split_index, str) else split_index
    return (F.floor((i - 1) / k) + 1).cast("int"), ((i - 1) % k + 1).cast("int")


def training_sizes(low: float, high: float, steps: int) -> list[float]:
    return [low + (high - low) * i / (steps - 1) for i in range(steps)]


def nested_subsets(df: DataFrame, keys: list[str], sizes: list[float], seed=42) -> DataFrame:
    """Add ``subset``: the smallest size (from 1) that contains the row; 0 = in none of them.

    Subset j is every row with ``1 <= subset <= j``, so each subset contains the smaller ones.
    """
    h = hash_key(seed, *keys)
    ranks = F.array(*[F.greatest(F.floor(F.lit(s) * F.col("n") + 1e-9).cast("long"), F.lit(1)) for s in sizes])
    cuts = hash_cuts(df.select(h.alias("h")), [], lambda totals: totals.withColumn("ranks", ranks))
    marked = attach_cuts(df.withColumn("__h", h), cuts.drop("n"), [])
    place = passed_cuts("__h")
    return marked.withColumn("subset", F.when(place >= len(sizes), 0).otherwise(place + 1)).drop("__h", "__cuts")
