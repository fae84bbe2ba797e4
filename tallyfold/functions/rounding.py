"""Rounding of result tables, so that two engines can be compared value by value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rounded(df: DataFrame, digits: int = 9, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column except ``keep``; adding 0.0 turns -0.0 into 0.0."""
    cols = [
        (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) and f.name not in keep
        else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    return df.select(*cols)
