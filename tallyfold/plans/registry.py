"""Named queries: a Spark callable and, where SQL can say it, the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load_all() -> None:
    from tallyfold.plans import (  # noqa: F401
        cleaning_queries,
        explain_queries,
        feature_queries,
        model_queries,
        profile_queries,
        resample_queries,
        score_queries,
        source_queries,
        split_queries,
        text_queries,
    )
