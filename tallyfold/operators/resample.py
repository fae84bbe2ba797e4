"""Class rebalancing of training rows: duplication, hash-ranked removal, interpolation, cleaning.

Frames have a unique ``key``, a 0/1 label ``y`` and a vector ``vec`` (``array<double>``). Results
have the same columns with string keys; a synthetic row is named ``<seed key>#<copy number>``.
Every random choice is a hash of the row key, so results do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cached_property
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.scalars import hash_key, hash_uniform
from tallyfold.operators.neighbours import knn
from tallyfold.operators.order import attach_cuts, hash_cuts
from tallyfold.runtime import lookup_join, settle, stage

STRATEGIES = (
    "none", "smote", "adasyn", "borderline_smote", "random_oversample", "random_undersample", "tomek", "smote_tomek",
    "smote_enn",
)
SMOTE_K = 5  # fixed values: neighbours per method
BORDER_K = 10
ENN_K = 3
COPY_RANGE = 100_000


def class_sizes(df: DataFrame, y: str = "y") -> tuple[int, int, int]:
    """(minority label, its rows, rows of the other class); the smaller label on equal sizes."""
    counts = sorted((r["n"], r[y]) for r in df.groupBy(y).agg(F.count("*").alias("n")).collect())
    if len(counts) != 2:
        raise ValueError("rebalancing needs exactly two classes")
    (small, label), (large, _) = counts
    return label, small, large


def _spread(df: DataFrame, total: int, rows: int, seed, key: str = "key") -> DataFrame:
    """Add ``copies`` so that they sum to ``total``: an equal share, the rest to the lowest hashes."""
    h = hash_key(f"{seed}|copies", key)
    whole, rest = divmod(total, rows)
    cuts = hash_cuts(df.select(h.alias("h")), [], lambda t: t.withColumn("ranks", F.array(F.lit(rest).cast("long"))))
    extra = (F.col("__h") <= F.col("__cuts")[0]).cast("int")
    return attach_cuts(df.withColumn("__h", h), cuts.drop("n"), []).withColumn("copies", F.lit(whole) + extra).drop("__h", "__cuts")


def _numbered_copies(df: DataFrame, total: int, key: str = "key") -> DataFrame:
    """One row per copy with its number ``copy``, 1 to ``copies``.

    A few seed rows may stand for a very large number of copies. They are first cut into ranges of
    COPY_RANGE and dealt out to enough tasks; a range is then expanded inside its task.
    """
    last = F.least(F.col("copies"), (F.col("range") + 1) * COPY_RANGE)
    ranged = df.where("copies > 0").withColumn("range", F.explode(F.expr(f"sequence(0, (copies - 1) div {COPY_RANGE})")))
    tasks = total // (10 * COPY_RANGE)
    if tasks > 1:
        ranged = ranged.repartition(min(tasks, 100_000), key, "range")
    numbers = F.sequence(F.col("range") * COPY_RANGE + 1, last).cast("array<int>")
    return ranged.withColumn("copy", F.explode(numbers)).drop("range", "copies")


def oversample_copies(df: DataFrame, key: str = "key", y: str = "y", seed=42) -> DataFrame:
    """(key, y, copy): the duplicates that lift the minority class to parity."""
    label, small, large = class_sizes(df, y)
    spread = _spread(df.where(F.col(y) == label), large - small, small, seed, key)
    return _numbered_copies(spread, large - small, key)


def undersample(df: DataFrame, key: str = "key", y: str = "y", seed=42) -> DataFrame:
    """Keep the minority class and as many majority rows, those with the lowest hashes."""
    label, small, _ = class_sizes(df, y)
    h = hash_key(f"{seed}|keep", key)
    majority = df.where(F.col(y) != label)
    cuts = hash_cuts(majority.select(h.alias("h")), [], lambda t: t.withColumn("ranks", F.array(F.lit(small).cast("long"))))
    row = cuts.first()
    return df.where((F.col(y) == label) | (h <= F.lit(row["cuts"][0])))


# Each step below that needs neighbours takes a table ``near`` (key, neighbour, rank) with at least its k of them, or searches.


def _nearest(near: DataFrame | None, queries: DataFrame, base: DataFrame, k: int) -> DataFrame:
    return knn(queries, base, k, "key", "vec") if near is None else near.where(F.col("rank") <= k)


def majority_share(df: DataFrame, label: int, k: int, near: DataFrame | None = None) -> DataFrame:
    """(key, others): how many of a minority row's k nearest rows belong to the other class."""
    near = _nearest(near, df.where(F.col("y") == label), df, k)
    classes = df.select(F.col("key").alias("neighbour"), "y")
    return near.join(classes, "neighbour").groupBy("key").agg(F.sum((F.col("y") != label).cast("long")).alias("others"))


def interpolated(
    minority: DataFrame, seeds: DataFrame, total: int, seed, k: int = SMOTE_K, near: DataFrame | None = None
) -> DataFrame:
    """(key, seed_key, copy, neighbour, u, vec): points between a seed row and one of its neighbours.

    ``seeds`` has ``(key, vec, copies)``, ``total`` copies in all. Neighbour lists are built once per seed row; the copies are
    exploded afterwards, so the join does not grow with the number of synthetic rows. ``near`` may hold rows that are no seeds.
    """
    near = _nearest(near, seeds, minority, k)
    points = minority.select(F.col("key").alias("neighbour"), F.col("vec").alias("nvec"))
    lists = near.join(points, "neighbour").groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("rank", "neighbour", "nvec"))).alias("near")
    )
    drawn = (
        _numbered_copies(seeds.select("key", "vec", "copies").join(lists, "key"), total)
        .withColumn("u", hash_uniform(hash_key(f"{seed}|step", "key", "copy")))
        .withColumn(
            "pick", F.floor(hash_uniform(hash_key(f"{seed}|neighbour", "key", "copy")) * F.size("near")).cast("int")
        )
        .withColumn("other", F.get("near", F.col("pick")))
    )
    vec = F.zip_with("vec", "other.nvec", lambda a, b: a + F.col("u") * (b - a))
    return drawn.select(
        F.concat_ws("#", "key", "copy").alias("key"),
        F.col("key").alias("seed_key"),
        "copy",
        F.col("other.neighbour").alias("neighbour"),
        "u",
        vec.alias("vec"),
    )


def _string_keys(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string").alias("key"), "y", "vec")


def _check_rows(small: int, k: int) -> None:
    if small <= k:
        raise ValueError(f"{small} minority rows are too few for {k} neighbours")


def smote_rows(df: DataFrame, seed=42, k: int = SMOTE_K, near: DataFrame | None = None) -> DataFrame:
    """Synthetic minority rows up to parity."""
    label, small, large = class_sizes(df)
    _check_rows(small, k)
    minority = df.where(F.col("y") == label)
    near = _nearest(near, minority, minority, k)
    return interpolated(minority, _spread(minority, large - small, small, seed), large - small, seed, k, near)


def adasyn_counts(df: DataFrame, k: int = SMOTE_K, near_all: DataFrame | None = None) -> DataFrame:
    """(key, others, copies): synthetic rows in proportion to the majority share nearby, half-even rounded."""
    label, small, large = class_sizes(df)
    _check_rows(small, k)
    shares = settle(majority_share(df, label, k, near_all))
    total = shares.agg(F.sum("others")).first()[0]
    if not total:
        raise ValueError("no minority row has a majority neighbour")
    copies = F.bround(F.col("others") * F.lit(float(large - small)) / F.lit(float(total)), 0).cast("int")
    return lookup_join(df.where(F.col("y") == label), shares, ["key"], "inner").withColumn("copies", copies)


def adasyn_rows(
    df: DataFrame, seed=42, k: int = SMOTE_K, near: DataFrame | None = None, near_all: DataFrame | None = None
) -> DataFrame:
    label, small, large = class_sizes(df)
    seeds = stage(adasyn_counts(df, k, near_all), "adasyn")
    return interpolated(df.where(F.col("y") == label), seeds, large - small, seed, k, near)


def danger_rows(df: DataFrame, k: int = BORDER_K, near_all: DataFrame | None = None) -> DataFrame:
    """Minority rows whose k neighbours are at least half, but not all, of the other class."""
    label = class_sizes(df)[0]
    shares = majority_share(df, label, k, near_all).where((F.col("others") * 2 >= k) & (F.col("others") < k))
    return df.where(F.col("y") == label).join(shares, "key", "left_semi")


def borderline_rows(
    df: DataFrame, seed=42, k: int = SMOTE_K, border_k: int = BORDER_K,
    near: DataFrame | None = None, near_all: DataFrame | None = None,
) -> DataFrame:
    """Synthetic rows seeded by danger rows only; none if there are no danger rows."""
    label, small, large = class_sizes(df)
    _check_rows(small, k)
    danger = stage(danger_rows(df, border_k, near_all), "danger")
    n = danger.count()
    minority = df.where(F.col("y") == label)
    seeds = _spread(danger, large - small, n, seed) if n else danger.withColumn("copies", F.lit(0))
    return interpolated(minority, seeds, large - small, seed, k, near)


def tomek_links(df: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """(key, other): rows of different classes that are each other's nearest row, both directions."""
    near = _nearest(near, df, df, 1).select("key", "neighbour")
    near = stage(near, "nearest")
    back = near.select(F.col("key").alias("neighbour"), F.col("neighbour").alias("key"))
    mutual = near.join(back, ["key", "neighbour"])
    classes = df.select("key", "y")
    other = classes.select(F.col("key").alias("neighbour"), F.col("y").alias("other_y"))
    return (
        mutual.join(classes, "key").join(other, "neighbour").where("y <> other_y")
        .select("key", F.col("neighbour").alias("other"))
    )


def drop_tomek(df: DataFrame, both: bool = False, near: DataFrame | None = None) -> DataFrame:
    """Remove the majority member of each link, or both members."""
    links = tomek_links(df, near).select("key")
    if both:
        return df.join(links, "key", "left_anti")
    label = class_sizes(df)[0]
    doomed = links.join(df.where(F.col("y") != label).select("key"), "key", "left_semi")
    return df.join(doomed, "key", "left_anti")


def drop_enn(df: DataFrame, k: int = ENN_K, near: DataFrame | None = None) -> DataFrame:
    """Remove every row, of either class, that has a neighbour of another class among its k."""
    near = _nearest(near, df, df, k)
    own = df.select("key", "y")
    other = own.select(F.col("key").alias("neighbour"), F.col("y").alias("other_y"))
    doomed = near.join(own, "key").join(other, "neighbour").where("y <> other_y").select("key")
    return df.join(doomed, "key", "left_anti")


def _with_synthetic(df: DataFrame, rows: DataFrame, label: int) -> DataFrame:
    return df.unionByName(rows.select("key", F.lit(label).cast(df.schema["y"].dataType).alias("y"), "vec"))


SMOTE_FAMILY = frozenset(("smote", "smote_tomek", "smote_enn"))


class Resampler:
    """Several of :data:`STRATEGIES` on the same ``(key, y, vec)`` rows; threads may ask for different ones at once.

    Neighbours and synthetic rows that more than one of ``strategies`` needs are made once and staged, neighbours with the largest k.
    """

    def __init__(self, df: DataFrame, strategies: Iterable[str], seed=42):
        self.df, self.seed, self.strategies = _string_keys(df), seed, frozenset(strategies)
        for strategy in self.strategies - set(STRATEGIES):
            raise ValueError(f"unknown sampling strategy {strategy!r}; choose one of {STRATEGIES}")
        self._made: dict[str, DataFrame] = {}
        self._locks = {name: Lock() for name in ("near", "near_all", "grown", "near_grown")}

    def _part(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        with self._locks[name]:
            if name not in self._made:
                self._made[name] = stage(make(), name)
            return self._made[name]

    @cached_property
    def label(self) -> int:
        return class_sizes(self.df)[0]

    def _near(self) -> DataFrame | None:
        """The SMOTE_K nearest minority rows of minority rows, if more than one step needs them."""
        minority = self.df.where(F.col("y") == self.label)
        users = [bool(self.strategies & SMOTE_FAMILY), "adasyn" in self.strategies, "borderline_smote" in self.strategies]
        return self._part("near", lambda: knn(minority, minority, SMOTE_K, "key", "vec")) if sum(users) > 1 else None

    def _near_all(self) -> DataFrame | None:
        """The BORDER_K nearest rows of minority rows."""
        if not {"adasyn", "borderline_smote"} <= self.strategies:
            return None
        minority = self.df.where(F.col("y") == self.label)
        return self._part("near_all", lambda: knn(minority, self.df, max(SMOTE_K, BORDER_K), "key", "vec"))

    def _grown(self) -> DataFrame:
        return self._part("grown", lambda: _with_synthetic(self.df, smote_rows(self.df, self.seed, near=self._near()), self.label))

    def _near_grown(self) -> DataFrame | None:
        if not {"smote_tomek", "smote_enn"} <= self.strategies:
            return None
        grown = self._grown()
        return self._part("near_grown", lambda: knn(grown, grown, max(1, ENN_K), "key", "vec"))

    def rows(self, strategy: str) -> DataFrame:
        """The rows after one of the strategies."""
        if strategy not in self.strategies:
            raise ValueError(f"{strategy!r} is none of the planned strategies")
        df, seed = self.df, self.seed
        if strategy == "none":
            return df
        if strategy == "random_undersample":
            return undersample(df, seed=seed)
        if strategy == "random_oversample":
            copies = oversample_copies(df, seed=seed)
            named = copies.select(F.concat_ws("#", "key", "copy").alias("key"), "y", "vec")
            return df.unionByName(named)
        if strategy == "tomek":
            return drop_tomek(df)
        if strategy == "smote_tomek":
            return drop_tomek(self._grown(), both=True, near=self._near_grown())
        if strategy == "smote_enn":
            return drop_enn(self._grown(), near=self._near_grown())
        if strategy == "smote":
            return self._grown()
        makers = {"adasyn": adasyn_rows, "borderline_smote": borderline_rows}
        made = makers[strategy](df, seed, near=self._near(), near_all=self._near_all())
        return stage(_with_synthetic(df, made, self.label), "resampled")


def resample(df: DataFrame, strategy: str, seed=42) -> DataFrame:
    """Apply one of :data:`STRATEGIES` to ``(key, y, vec)`` training rows."""
    return Resampler(df, (strategy,), seed).rows(strategy)
