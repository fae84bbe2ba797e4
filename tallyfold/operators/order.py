"""Exact order statistics without a global sort.

Three building blocks that the profiling, splitting, scaling and curve operators share:

* ``ordered_cumsum``    two-level running sums: quantile buckets, then sums inside each bucket
* ``exact_percentiles`` a sketch brackets each quantile, one counting pass makes it exact
* ``hash_cuts``         the hash value found at a given rank, so that "the first n rows in hash
                        order" becomes a plain comparison on every row
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.runtime import bounded_rows, lookup_join, settle, skewed_join, stage, staged_once

# Up to this many rows one window per group is cheaper than bucketing.
SINGLE_WINDOW_ROWS = 200_000
SKETCH_ACCURACY = 10_000
MOMENTS = {"mean": F.avg, "std": F.stddev, "min": F.min, "max": F.max}
# 16**4 hash prefixes: few enough to combine well on the map side, and at 10**12 rows the rows that
# share a prefix (the only ones ranked) still fit one task.
PREFIX_DIGITS = 4


def ordered_cumsum(
    df: DataFrame,
    order: str,
    values: list[str],
    by: list[str] | None = None,
    descending: bool = False,
    leads: list[str] | None = None,
    single_window_rows: int = SINGLE_WINDOW_ROWS,
) -> DataFrame:
    """Add ``cum_<v>`` (inclusive running sum in ``order``) for every value column.

    ``df`` holds one row per (``by``, ``order``). It is staged once. Small frames use one window per
    group; larger ones are cut at approximate quantiles of ``order`` into buckets that no group or
    value can overfill, bucket totals are accumulated in a small table, and only the running sum
    inside a bucket needs a sort. ``leads`` adds ``next_<c>``: the value in the following row.
    """
    by, leads = list(by or []), list(leads or [])
    staged = staged_once(df, "ordered")
    rows = staged.count()
    key = F.desc if descending else F.asc
    if rows <= single_window_rows:
        w = Window.partitionBy(*by).orderBy(key(order))
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        return staged.withColumns(
            {f"cum_{v}": F.sum(v).over(run) for v in values} | {f"next_{c}": F.lead(c).over(w) for c in leads}
        )

    n_buckets = int(min(9_000, max(8, rows // single_window_rows * 4)))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = staged.agg(F.percentile_approx(order, probs, 2 * n_buckets)).first()[0]
    splits = [float("-inf"), *sorted(set(map(float, cuts))), float("inf")]
    bucketed = (
        Bucketizer(splits=splits, inputCol="__order", outputCol="__bucket", handleInvalid="keep")
        .transform(staged.withColumn("__order", F.col(order).cast("double")))
        .drop("__order")
    )
    edge = F.max_by if descending else F.min_by
    totals = bucketed.groupBy(*by, "__bucket").agg(
        *[F.sum(v).alias(f"__t_{v}") for v in values], *[edge(c, order).alias(f"__f_{c}") for c in leads]
    )
    # One row per (group, bucket): small, so a window per group is fine here.
    across = Window.partitionBy(*by).orderBy(key("__bucket"))
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "__bucket",
        *[F.coalesce(F.sum(f"__t_{v}").over(before), F.lit(0)).alias(f"__o_{v}") for v in values],
        *[F.lead(f"__f_{c}").over(across).alias(f"__n_{c}") for c in leads],
    )
    inside = Window.partitionBy(*by, "__bucket").orderBy(key(order))
    run = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = lookup_join(bucketed, offsets, [*by, "__bucket"], "inner")
    out = out.withColumns(
        {f"cum_{v}": F.sum(v).over(run) + F.col(f"__o_{v}") for v in values}
        | {f"next_{c}": F.coalesce(F.lead(c).over(inside), F.col(f"__n_{c}")) for c in leads}
    )
    return out.select(*staged.columns, *[f"cum_{v}" for v in values], *[f"next_{c}" for c in leads])


def average_rank(df: DataFrame, score: str, by: list[str] | None = None, out: str = "avg_rank") -> DataFrame:
    """Average rank of ``score`` (ties share it) divided by the largest rank."""
    by = list(by or [])
    counts = stage(df.where(F.col(score).isNotNull()).groupBy(*by, score).agg(F.count("*").alias("__n")), "ranks")
    cum = ordered_cumsum(counts, score, ["__n"], by)
    rank = F.col("cum___n") - F.col("__n") + (F.col("__n") + 1) / 2
    # The largest rank follows from the group size and the count of its largest score.
    top = counts.groupBy(*by).agg((F.sum("__n") - (F.max_by("__n", score) - 1) / 2).alias("__max"))
    scaled = _attach_totals(cum, top, by).select(*by, score, (rank / F.col("__max")).alias(out))
    return skewed_join(df, scaled, [*by, score], counts, "__n")


def exact_percentiles(
    df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None, accuracy: int = SKETCH_ACCURACY,
    moments: bool = False,
) -> DataFrame:
    """Exact linear-interpolated percentiles: rows ``(by..., column, n, q)`` with ``q`` one value per prob.

    ``moments`` adds mean, std, min and max, measured in the sketch's own pass.

    A quantile sketch narrows each percentile to a bracket about ``6 / accuracy`` of the rows wide.
    One pass then counts rows outside the brackets into a handful of groups and keeps distinct values
    inside them, so neither the whole column nor a heavy tie reaches a single task. Nulls and NaN are
    left out.
    """
    by = list(by or [])
    groups = [*by, "column"]
    long = (
        df.select(*by, *[F.col(_q(c)).cast("double").alias(c) for c in cols])
        .unpivot(by, [_q(c) for c in cols], "column", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )
    slack = 3.0 / accuracy
    probes = [max(0.0, p - slack) for p in probs] + [min(1.0, p + slack) for p in probs]
    sketch = long.groupBy(*groups).agg(
        F.count("*").alias("n"),
        F.percentile_approx("value", probes, accuracy).alias("probe"),
        *[fn("value").alias(name) for name, fn in (MOMENTS.items() if moments else ())],
    )
    m = len(probs)
    whole = F.col("n") <= 5 * accuracy
    inf = F.lit(float("inf"))
    brackets = settle(
        sketch.select(
            *groups,
            "n",
            *(MOMENTS if moments else ()),
            *[F.when(whole | F.lit(p <= slack), -inf).otherwise(F.col("probe")[i]).alias(f"lo{i}") for i, p in enumerate(probs)],
            *[F.when(whole | F.lit(p >= 1 - slack), inf).otherwise(F.col("probe")[m + i]).alias(f"hi{i}") for i, p in enumerate(probs)],
        ),
        "brackets",
    )
    extra = list(MOMENTS) if moments else []
    picked = _pick(long, brackets.drop(*extra), groups, probs)
    if not picked.where(F.exists("q", lambda v: v.isNull())).isEmpty():
        # A bracket missed its rank (the sketch bound is probabilistic in practice): count every value.
        opened = brackets.withColumns({f"lo{i}": -inf for i in range(m)} | {f"hi{i}": inf for i in range(m)})
        picked = _pick(long, opened.drop(*extra), groups, probs)
    return lookup_join(picked, brackets.select(*groups, *extra), groups, "inner") if moments else picked


def _pick(long: DataFrame, brackets: DataFrame, groups: list[str], probs: list[float]) -> DataFrame:
    m = len(probs)
    inside = F.lit(False)
    gap = F.lit(0)
    for i in range(m):
        inside = inside | F.col("value").between(F.col(f"lo{i}"), F.col(f"hi{i}"))
        gap = gap + (F.col("value") > F.col(f"hi{i}")).cast("int")
    counted = (
        lookup_join(long, brackets.drop("n"), groups, "inner")
        .select(*groups, "value", F.when(inside, F.col("value")).alias("kept"), F.when(inside, -1).otherwise(gap).alias("gap"))
        .groupBy(*groups, "kept", "gap")
        .agg(F.count("*").alias("cnt"), F.min("value").alias("at"))
    )
    cum = ordered_cumsum(counted, "at", ["cnt"], groups)
    cum = lookup_join(cum, brackets.select(*groups, "n"), groups, "inner")
    before = F.col("cum_cnt") - F.col("cnt")

    def value_at(rank: Column) -> Column:
        return F.max(F.when((before <= rank) & (rank < F.col("cum_cnt")), F.col("kept")))

    def percentile(p: float) -> Column:
        position = F.lit(p) * (F.col("n") - 1)
        low, high = value_at(F.floor(position)), value_at(F.ceil(position))
        fraction = F.max(position - F.floor(position))
        return low + (high - low) * fraction

    return settle(
        cum.groupBy(*groups).agg(F.first("n").alias("n"), F.array(*[percentile(p) for p in probs]).alias("q")),
        "percentiles",
    )


def hash_cuts(keys: DataFrame, strata: list[str], targets: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Hash values at chosen ranks of each stratum.

    ``keys`` has the strata columns and ``h`` (hex md5). ``targets`` maps the stratum sizes
    ``(strata..., n)`` to ``(strata..., ranks)`` with ``ranks`` an ascending array of 1-based ranks
    (0 = before the first row). Returns ``(strata..., n, cuts)``; a row is among the first
    ``ranks[i]`` of its stratum exactly when ``h <= cuts[i]``.

    Counting by hash prefix finds the prefix holding each rank; only rows with that prefix are
    ranked. Everything else about a split is then a comparison, with no shuffle of the data.
    """
    if not strata:
        keys, strata = keys.withColumn("__all", F.lit(0)), ["__all"]
    prefixed = keys.withColumn("__prefix", F.substring("h", 1, PREFIX_DIGITS))
    hist = stage(prefixed.groupBy(*strata, "__prefix").agg(F.count("*").alias("cnt")), "prefixes")
    sizes = hist.groupBy(*strata).agg(F.sum("cnt").alias("n"))
    wanted = settle(targets(sizes).select(*strata, "n", "ranks"), "targets")
    w = Window.partitionBy(*strata).orderBy("__prefix").rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.withColumn("upto", F.sum("cnt").over(w)).withColumn("before", F.col("upto") - F.col("cnt"))
    located = (
        _attach_totals(cum, wanted.select(*strata, "ranks"), strata)
        .select(
            *strata,
            "__prefix",
            F.filter(
                F.transform("ranks", lambda r: r - F.col("before")), lambda need: (need >= 1) & (need <= F.col("cnt"))
            ).alias("need"),
            "before",
        )
        .where(F.size("need") > 0)
    )
    located = settle(located, "located")
    boundary = lookup_join(prefixed, located, [*strata, "__prefix"], "inner")
    rank = F.row_number().over(Window.partitionBy(*strata, "__prefix").orderBy("h"))
    found = (
        boundary.withColumn("rn", rank)
        .where(F.array_contains("need", F.col("rn").cast("long")))
        .groupBy(*strata)
        .agg(F.map_from_entries(F.collect_list(F.struct((F.col("before") + F.col("rn")).alias("k"), "h"))).alias("at"))
    )
    joined = lookup_join(wanted, found, strata, "left")
    cuts = F.transform("ranks", lambda r: F.coalesce(F.element_at("at", r), F.lit("")))
    return settle(joined.select(*strata, "n", cuts.alias("cuts")), "cuts").drop("__all")


def passed_cuts(h="h", cuts="__cuts") -> Column:
    """How many cuts a hash lies beyond: 0 for the first block, and so on."""
    return F.size(F.filter(cuts, lambda c: c < F.col(h)))


def attach_cuts(df: DataFrame, cuts: DataFrame, strata: list[str]) -> DataFrame:
    """Add ``__cuts``, those of each row's stratum; rows of a stratum that was not cut stay, without them."""
    cuts = cuts.withColumnRenamed("cuts", "__cuts")
    return lookup_join(df, cuts, strata, "left") if strata else _attach_totals(df, cuts, strata)


def _attach_totals(df: DataFrame, totals: DataFrame, by: list[str]) -> DataFrame:
    """Join one row per group; without groups the single row becomes literals."""
    if by:
        return lookup_join(df, totals, by, "inner")
    rows = bounded_rows(totals, 1)
    row = rows[0] if rows else None
    return df.withColumns(
        {
            f.name: F.lit(row[f.name] if row is not None else None).cast(f.dataType)
            for f in totals.schema
            if f.name not in df.columns
        }
    )


def _q(name: str) -> str:
    return f"`{name}`"
