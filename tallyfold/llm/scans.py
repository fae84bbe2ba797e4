"""Positions and running exclusive-ors inside groups, where one group may be far larger than a task should hold.

Rows are laid out by range over (group, order), so a large group simply spans several partitions. Every partition is scanned on
its own; what a group brings along from earlier partitions is one row per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyfold.llm.words import release
from tallyfold.runtime import stage

_EXTRA = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("is_total", T.BooleanType()), T.StructField("nth", T.LongType()),
    T.StructField("x1", T.LongType()), T.StructField("x2", T.LongType()),
])


def group_scan(rows: DataFrame, group: str, order: list[str | Column], v1: str | None = None, v2: str | None = None) -> DataFrame:
    """``rows`` with ``nth`` (from 1, in ``order`` inside ``group``) and ``x1``, ``x2``: the exclusive-or of ``v1``, ``v2`` up to the row.

    ``group`` is a long column without nulls, ``v1`` and ``v2`` are longs; (group, order) must name a row. ``rows`` should be a staged
    table, as its range borders are sampled first. The result is staged.
    """
    arrow = to_arrow_schema(T.StructType([*rows.schema.fields, *_EXTRA.fields]))
    names = rows.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, n, carry = None, 0, [np.int64(0), np.int64(0)]
        for batch in batches:
            if not batch.num_rows:
                continue
            g = batch.column(names.index(group)).to_numpy(zero_copy_only=False)
            begins = np.ones(len(g), bool)
            begins[1:] = g[1:] != g[:-1]
            first = np.flatnonzero(begins)
            run = np.cumsum(begins) - 1
            goes_on = last is not None and g[0] == last
            nth = np.arange(1, len(g) + 1) - first[run]
            ahead = run == 0
            if goes_on:
                nth[ahead] += n
            sums = []
            for k, name in enumerate((v1, v2)):
                if name is None:
                    sums.append(np.zeros(len(g), np.int64))
                    continue
                acc = np.bitwise_xor.accumulate(batch.column(names.index(name)).to_numpy(zero_copy_only=False))
                before = np.concatenate([[np.int64(0)], acc])[first]
                x = acc ^ before[run]
                if goes_on:
                    x[ahead] ^= carry[k]
                sums.append(x)
            last, n, carry = g[-1], nth[-1], [s[-1] for s in sums]
            extra = [np.full(len(g), part, np.int32), np.zeros(len(g), bool), nth, *sums]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, extra)], schema=arrow)
        if last is not None:  # what the partition's last group has gathered here
            values = {group: int(last), "part": part, "is_total": True, "nth": int(n), "x1": int(carry[0]), "x2": int(carry[1])}
            yield pa.RecordBatch.from_pylist([{f.name: values.get(f.name) for f in arrow}], schema=arrow)
        release()

    keys = [F.col(group), *(F.col(c) if isinstance(c, str) else c for c in order)]
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    scanned = stage(laid.mapInArrow(scan, T.StructType([*rows.schema.fields, *_EXTRA.fields])), "scanned")
    # One row per partition: its last group and what that group has so far, handed to the next partition that has rows.
    totals = sorted(scanned.where("is_total").select("part", group, "nth", "x1", "x2").collect())
    carried, so_far = [], None
    for here, after in zip(totals, totals[1:]):
        if so_far is not None and so_far[0] == here[1]:
            so_far = (here[1], so_far[1] + here[2], so_far[2] ^ here[3], so_far[3] ^ here[4])
        else:
            so_far = tuple(here[1:])
        if after[1] < here[1]:
            raise RuntimeError("the partitions are not in the order of their groups")
        carried.append((after[0], *so_far))
    schema = f"part int, {group} long, _n long, _x1 long, _x2 long"
    brought = F.broadcast(rows.sparkSession.createDataFrame(carried, schema))
    zero = F.lit(0).cast("long")
    return (
        scanned.where("NOT is_total").join(brought, ["part", group], "left")
        .withColumns({
            "nth": F.col("nth") + F.coalesce("_n", zero), "x1": F.col("x1").bitwiseXOR(F.coalesce("_x1", zero)),
            "x2": F.col("x2").bitwiseXOR(F.coalesce("_x2", zero)),
        })
        .select(*names, "nth", "x1", "x2")
    )
