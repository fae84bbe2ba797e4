"""What a score owes to its features: permutation importance and partial dependence of any scorer.

A scorer is a function that takes a DataFrame with the feature columns and adds ``p`` and ``label`` to it, with its other columns kept.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.scalars import hash_key
from tallyfold.operators.curves import ranking_metrics
from tallyfold.operators.metrics import binary_metrics
from tallyfold.operators.order import PREFIX_DIGITS, exact_percentiles
from tallyfold.runtime import bounded_rows, local_frame, lookup_join, staged_once

Scorer = Callable[[DataFrame], DataFrame]
RANKING = ("roc_auc", "pr_auc")


def hash_ranked(rows: DataFrame, h: Column, by: list[str], out: str) -> DataFrame:
    """Add the 1-based rank of a row by a hex hash within ``by``: rows are sorted per hash prefix, prefixes are counted."""
    marked = rows.withColumn("__prefix", F.conv(F.substring(h, 1, PREFIX_DIGITS), 16, 10).cast("int"))
    counts = marked.groupBy(*by, "__prefix").agg(F.count("*").alias("__n"))
    # At most 16^4 rows per group.
    before = Window.partitionBy(*by).orderBy("__prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "__prefix", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy(*by, "__prefix").orderBy("__h"))
    # The hash is longer than many a row: it is taken again where the rows have arrived, not sent with them.
    ranked = marked.repartition(*by, "__prefix").withColumn("__h", h).withColumn("__rn", rank).drop("__h")
    located = lookup_join(ranked, offsets, [*by, "__prefix"], "inner")
    return located.withColumn(out, F.col("__before") + F.col("__rn")).drop("__prefix", "__before", "__rn")


def permuted_features(df: DataFrame, key: list[str], features: list[str], repeats: int = 5, seed: int = 42) -> DataFrame:
    """Rows of ``df`` once per repeat, with ``donor``: the features of another row, every row being donor once a repeat.

    A row that ranks k-th in one hash order takes from the row that ranks k-th in another: a permutation of all rows by two
    exchanges and an equi-join on unique ranks, without a global sort. ``key`` identifies a row; null features are donated like others.
    """
    df = staged_once(df, "features")
    repeat = F.explode(F.array(*[F.lit(r) for r in range(1, repeats + 1)])).alias("repeat")
    take = df.select("*", repeat)
    give = df.select(*key, F.struct(*[F.col(f"`{c}`") for c in features]).alias("donor"), repeat)
    take = hash_ranked(take, hash_key(f"{seed}|take", "repeat", *key), ["repeat"], "__rank")
    give = hash_ranked(give, hash_key(f"{seed}|give", "repeat", *key), ["repeat"], "__rank").drop(*key)
    return take.join(give, ["repeat", "__rank"]).drop("__rank")


def permutation_importance(
    df: DataFrame, key: list[str], features: list[str], scorer: Scorer, metric: str = "mcc", repeats: int = 5, seed: int = 42, y: str = "y"
) -> DataFrame:
    """(feature, baseline, importance, importance_std): what the metric loses when one column's values change rows.

    ``importance_std`` is over the repeats (divisor: their number). One permutation of a repeat serves all features: a row is scored
    once per feature, with that one value taken from its donor. An empty frame has no rows.
    """
    df = staged_once(df.select(*key, y, *features), "features")
    moved = permuted_features(df, key, features, repeats, seed)
    cells = moved.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))).alias("__cell"))
    variants = cells.select(
        y, "repeat", "__cell",
        *[F.when(F.col("__cell") == i, F.col("donor")[c]).otherwise(F.col(f"`{c}`")).alias(c) for i, c in enumerate(features)],
    )

    def measured(scored: DataFrame, by: list[str]) -> DataFrame:
        table = ranking_metrics(scored, by, y) if metric in RANKING else binary_metrics(scored, by, only=(metric,), y=y)
        return table.select(*by, F.col(metric).alias("value"))

    # A constant as the group, so that the baseline of an empty frame is no row.
    base = bounded_rows(measured(scorer(df.withColumn("__all", F.lit(0))), ["__all"]), 1)
    baseline = F.lit(base[0]["value"] if base else None).cast("double")
    lost = measured(scorer(variants), ["__cell", "repeat"]).withColumn("baseline", baseline)
    names = local_frame(df.sparkSession, list(enumerate(features)), T._parse_datatype_string("__cell int, feature string"))
    drop = F.col("baseline") - F.col("value")
    return lookup_join(lost, names, ["__cell"], "inner").groupBy("feature").agg(
        F.first("baseline").alias("baseline"), F.avg(drop).alias("importance"), F.stddev_pop(drop).alias("importance_std")
    )


def feature_grids(
    df: DataFrame, features: list[str], resolution: int = 100, low: float = 0.05, high: float = 0.95
) -> dict[str, list]:
    """Per feature the points to score at: its distinct values if there are at most ``resolution``, else equal steps between two percentiles.

    Nulls and NaN are no points. A column that is no number must not have more distinct values than ``resolution``.
    """
    df = staged_once(df.select(*features), "features")
    grids, wide = {}, []
    for c in features:
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        value = F.col(f"`{c}`").cast("double") if numeric else F.col(f"`{c}`")
        known = value.isNotNull() & ~F.isnan(value) if numeric else value.isNotNull()
        found = bounded_rows(df.where(known).select(value.alias("v")).distinct(), resolution)
        if found is None and not numeric:
            raise ValueError(f"{c!r} has more than {resolution} values; give its grid")
        grids[c] = sorted(r["v"] for r in found) if found is not None else []
        wide += [c] if found is None else []
    if wide:
        for r in exact_percentiles(df, wide, [low, high]).collect():  # one row per feature
            grids[r["column"]] = sorted(set(np.linspace(r["q"][0], r["q"][1], resolution).tolist()))
    return grids


def partial_dependence(
    df: DataFrame, features: list[str], scorer: Scorer, grids: dict[str, list] | None = None, resolution: int = 100
) -> DataFrame:
    """(feature, point, value, category, n, mean_p): the mean score of all rows when one feature is set to a grid point in each.

    ``features`` are all columns that the scorer reads; those of ``grids`` (all, if it is not given) are varied. A row is repeated
    for every point inside its task, and only sums per point are exchanged. ``value`` is null for strings, ``category`` for numbers.
    """
    grids = feature_grids(df, features, resolution) if grids is None else grids
    points = [(c, i, v) for c in features for i, v in enumerate(grids.get(c, []))]
    first = {c: next(i for i, p in enumerate(points) if p[0] == c) for c in features if grids.get(c)}
    kind = "cell int, feature string, point int, value double, category string"
    known = [
        (i, c, at, None if isinstance(v, str) else float(v), v if isinstance(v, str) else None) for i, (c, at, v) in enumerate(points)
    ]
    labels = local_frame(df.sparkSession, known, T._parse_datatype_string(kind))
    if not points:
        return labels.select("feature", "point", "value", "category", F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean_p"))
    cell = F.col("__cell")

    def at_cell(c: str) -> Column:
        own = F.col(f"`{c}`")
        if c not in first:
            return own
        # Numbers are set as they stand in the grid, also in a column of whole numbers.
        own = own.cast("double") if isinstance(df.schema[c].dataType, T.NumericType) else own
        start, size = first[c], len(grids[c])
        given = F.get(F.lit(list(grids[c])), cell - start)
        return F.when(cell.between(start, start + size - 1), given).otherwise(own)

    cells = df.select(*features, F.explode(F.sequence(F.lit(0), F.lit(len(points) - 1))).alias("__cell"))
    variants = cells.select("__cell", *[at_cell(c).alias(c) for c in features])
    sums = scorer(variants).groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.avg("p").alias("mean_p"))
    return lookup_join(sums, labels, ["cell"], "inner").select("feature", "point", "value", "category", "n", "mean_p")
