"""Run a registered query and its SQL and compare them value by value."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, repr(v + 0.0))
    return (1, repr(v))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences as text; empty when names, row count, kinds and values agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    got = [tuple(r) for r in spark_df.collect()]
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    if len(got) != len(expected):
        problems.append(f"rows {len(got)} != {len(expected)}")
    a, b = canonical(spark_df.columns, got), canonical(names, expected)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ: {diff}")
    duck_types = {d[0]: str(d[1]) for d in result.description}
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    for f in spark_df.schema:
        kind = f.dataType.simpleString()
        if kind in kinds and kinds[kind] not in duck_types[f.name]:
            problems.append(f"type of {f.name}: {kind} vs {duck_types[f.name]}")
    return problems
