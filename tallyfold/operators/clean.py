"""Cleaning, encoding and assembling rows and columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.order import average_rank
from tallyfold.operators.profile import columns_by_type, frequency_table, q, top_values
from tallyfold.runtime import bounded_rows


def sentinel_to_null(df: DataFrame, sentinel: str = "?", cols: list[str] | None = None) -> DataFrame:
    cols = columns_by_type(df)[0] if cols is None else cols
    return df.withColumns({c: F.nullif(q(c), F.lit(sentinel)) for c in cols})


def mode_values(df: DataFrame, cols: list[str]) -> dict[str, str]:
    """Most frequent non-null value per column, the smallest on ties."""
    return {r["column"]: r["top"] for r in top_values(frequency_table(df, cols)).collect()}


def mode_fill(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Fill nulls of string columns with their mode."""
    cols = columns_by_type(df)[0] if cols is None else cols
    modes = mode_values(df, cols)
    return df.withColumns({c: F.coalesce(q(c), F.lit(m)) for c, m in modes.items()})


def drop_target(df: DataFrame, target: str) -> DataFrame:
    return df.drop(target)


def binary_classes(df: DataFrame, target: str) -> list[str]:
    """The two trimmed class names in sorted order."""
    found = df.select(F.trim(q(target).cast("string")).alias("c")).where("c is not null").distinct()
    classes = bounded_rows(found, 2)
    if classes is None or len(classes) != 2:
        raise ValueError(f"{target!r} must have exactly two classes")
    return sorted(r["c"] for r in classes)


def encode_binary(df: DataFrame, target: str, out: str = "y", classes: list[str] | None = None) -> DataFrame:
    """Trim the target and encode it 0/1 in sorted class order."""
    classes = classes or binary_classes(df, target)
    text = F.trim(q(target).cast("string"))
    return df.withColumn(out, F.when(text == classes[1], 1).when(text == classes[0], 0))


def join_blocks(blocks: list[DataFrame], key: str) -> DataFrame:
    """Column-wise concatenation of blocks that were stored apart; one frame needs only ``withColumns``."""
    return reduce(lambda a, b: a.join(b, key, "inner"), blocks)


def reorder(df: DataFrame, order: list[str]) -> DataFrame:
    """Columns in the given order, unknown ones last as they were."""
    known = [c for c in order if c in df.columns]
    return df.select(*[q(c) for c in known + [c for c in df.columns if c not in known]])


def stack_rows(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def top_k(df: DataFrame, score: str, k: int, *tie_break: str) -> DataFrame:
    """The k largest rows; planned as a per-partition top-k and a merge."""
    return df.orderBy(F.desc(score), *tie_break).limit(k)


def best_row(df: DataFrame, score: str, order: str, by: list[str] | None = None) -> DataFrame:
    """The row with the largest score per group, the first one in ``order`` on ties. Null scores lose."""
    by = list(by or [])
    rest = [c for c in df.columns if c not in by]
    rank = F.struct(F.col(score), (-F.col(order).cast("double")).alias("back"))
    picked = F.max_by(F.struct(*[q(c) for c in rest]), rank)
    usable = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))
    return df.where(usable).groupBy(*by).agg(picked.alias("r")).select(*by, "r.*")


def group_summary(df: DataFrame, by: list[str], cols: list[str], stats: tuple[str, ...] = ("mean", "std")) -> DataFrame:
    """``{stat}_{column}`` per group; std is the sample one. Medians are for small result tables."""
    functions = {"mean": F.avg, "std": F.stddev, "std_pop": F.stddev_pop, "median": F.median, "min": F.min, "max": F.max}
    return df.groupBy(*by).agg(*[functions[s](q(c)).alias(f"{s}_{c}") for c in cols for s in stats])


def rank_scaled(df: DataFrame, score: str, out: str, by: list[str] | None = None) -> DataFrame:
    return average_rank(df, score, by, out)
