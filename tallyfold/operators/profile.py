"""Exploratory tables: the data behind column summaries, histograms, box plots and heatmaps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.operators.order import exact_percentiles
from tallyfold.runtime import bounded_rows, lookup_join, settle


def q(name: str) -> Column:
    """Column by name, dots and dashes included."""
    return F.col(f"`{name}`")


def columns_by_type(df: DataFrame, exclude: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """(categorical, numeric): strings are categorical, numbers numeric, the rest neither."""
    fields = [f for f in df.schema if f.name not in exclude]
    return (
        [f.name for f in fields if isinstance(f.dataType, T.StringType)],
        [f.name for f in fields if isinstance(f.dataType, T.NumericType)],
    )


def preview_rows(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    return df.orderBy(order).limit(n)


def _per_column(df: DataFrame, cols: list[str], measure, value: str) -> DataFrame:
    """One aggregate over all columns, turned into rows ``(column, value)``."""
    one = df.agg(*[measure(q(c)).alias(f"v{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias(value)) for i, c in enumerate(cols)])
    return one.select(F.inline(pairs))


def column_info(df: DataFrame) -> DataFrame:
    """(position, column, type, non_null)."""
    counts = _per_column(df, df.columns, F.count, "non_null")
    kinds = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)],
        "position int, column string, type string",
    )
    return kinds.join(counts, "column").select("position", "column", "type", "non_null")


def sentinel_counts(df: DataFrame, sentinel: str = "?") -> DataFrame:
    """How often the missing-value marker occurs per string column; columns without it are left out."""
    cats, _ = columns_by_type(df)
    counts = _per_column(df, cats, lambda c: F.coalesce(F.sum((c == sentinel).cast("long")), F.lit(0)), "n")
    return counts.where("n > 0").orderBy(F.desc("n"), "column")


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls, has_null)."""
    counts = _per_column(df, df.columns, lambda c: F.coalesce(F.sum(c.isNull().cast("long")), F.lit(0)), "nulls")
    return counts.withColumn("has_null", (F.col("nulls") > 0).cast("int"))


def null_total(df: DataFrame) -> DataFrame:
    return null_counts(df).agg(F.sum("nulls").alias("nulls"))


def frequency_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, cnt) for the non-null values of several columns in one shuffle."""
    return (
        df.select(*[q(c).cast("string").alias(c) for c in cols])
        .unpivot([], [q(c) for c in cols], "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("cnt"))
    )


def top_values(freq: DataFrame) -> DataFrame:
    """(column, count, unique, top, freq) from a frequency table; the smallest value wins a tie."""
    return (
        freq.groupBy("column")
        .agg(
            F.sum("cnt").alias("count"),
            F.count("*").alias("unique"),
            F.min(F.struct((-F.col("cnt")).alias("less"), F.col("value").alias("top"))).alias("best"),
        )
        .select("column", "count", "unique", "best.top", (-F.col("best.less")).alias("freq"))
    )


def describe_mixed(df: DataFrame) -> DataFrame:
    """One row per column: count, unique, top, freq, mean, std, min, quartiles, max.

    Three scans: value frequencies of the categorical columns, moments and quantile sketch of the
    numeric ones, and the pass that makes the quartiles exact.
    """
    cats, nums = columns_by_type(df)
    position = {c: i for i, c in enumerate(df.columns)}
    parts = []
    if cats:
        parts.append(top_values(frequency_table(df, cats)))
    if nums:
        quart = [F.col("q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))]
        table = exact_percentiles(df, nums, [0.25, 0.5, 0.75], moments=True)
        parts.append(table.select("column", F.col("n").alias("count"), "mean", "std", "min", *quart, "max"))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    listed = df.sparkSession.createDataFrame(
        [(i, c) for c, i in position.items() if c in cats + nums], "position int, column string"
    )
    wanted = {
        "count": "long", "unique": "long", "top": "string", "freq": "long", "mean": "double", "std": "double",
        "min": "double", "p25": "double", "p50": "double", "p75": "double", "max": "double",
    }
    # A column without any value keeps its row, with count 0.
    return (
        listed.join(out, "column", "left").fillna({"count": 0})
        .select(
            "position", "column",
            *[(F.col(c) if c in out.columns else F.lit(None)).cast(t).alias(c) for c, t in wanted.items()],
        )
    )


def value_counts(df: DataFrame, col: str, by_count: bool = True) -> DataFrame:
    counts = df.where(q(col).isNotNull()).groupBy(q(col).alias(col)).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), q(col)) if by_count else counts.orderBy(q(col))


def proportions(df: DataFrame, col: str) -> DataFrame:
    """(col, n, share); nulls are not counted. The window runs over aggregated rows only."""
    counts = df.where(q(col).isNotNull()).groupBy(q(col).alias(col)).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share", F.col("n") / total)


def histogram(df: DataFrame, cols: list[str], bins: int = 30) -> DataFrame:
    """(column, bin, low, high, n): equal-width bins, last one closed, empty bins kept."""
    ranges = df.agg(
        *[f(q(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    edges = []
    for i, c in enumerate(cols):
        lo, hi = ranges[f"lo{i}"], ranges[f"hi{i}"]
        if lo is not None:
            lo, hi = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
            edges.append((c, lo, hi))

    def bin_of(c: str, lo: float, hi: float) -> Column:
        slot = F.least(F.floor((q(c).cast("double") - lo) / ((hi - lo) / bins)).cast("int"), F.lit(bins - 1))
        return F.when(q(c).isNotNull(), slot)  # least() alone would turn null into the last bin

    spark = df.sparkSession
    binned = df.select(*[bin_of(*e).alias(e[0]) for e in edges]).unpivot([], [q(e[0]) for e in edges], "column", "bin")
    counts = binned.where(F.col("bin").isNotNull()).groupBy("column", "bin").agg(F.count("*").alias("n"))
    grid = [(c, b, lo + b * ((hi - lo) / bins), lo + (b + 1) * ((hi - lo) / bins)) for c, lo, hi in edges for b in range(bins)]
    frame = spark.createDataFrame(grid, "column string, bin int, low double, high double")
    return frame.join(counts, ["column", "bin"], "left").fillna({"n": 0})


def box_stats(df: DataFrame, cols: list[str], cls: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest value within ``reach`` IQR) and outlier count per column and class."""
    quart = exact_percentiles(df, cols, [0.25, 0.5, 0.75], [cls]).select(
        cls, "column", "n", *[F.col("q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    )
    long = (
        df.select(q(cls).alias(cls), *[q(c).cast("double").alias(c) for c in cols])
        .unpivot([cls], [q(c) for c in cols], "column", "value")
        .where(F.col("value").isNotNull())
    )
    iqr = F.col("q3") - F.col("q1")
    inside = F.col("value").between(F.col("q1") - reach * iqr, F.col("q3") + reach * iqr)
    return (
        lookup_join(long, quart, [cls, "column"], "inner")
        .groupBy(cls, "column", "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum((~inside).cast("long")).alias("outliers"),
        )
    )


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """(a, b, corr) for every ordered pair, nulls deleted pair by pair, in one aggregate."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    one = df.agg(*[F.corr(q(cols[i]).cast("double"), q(cols[j]).cast("double")).alias(f"c{i}_{j}") for i, j in pairs])
    cells = [
        F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"), F.col(f"c{min(i, j)}_{max(i, j)}").alias("corr"))
        for i in range(len(cols))
        for j in range(len(cols))
    ]
    return one.select(F.inline(F.array(*cells)))


def category_class_counts(df: DataFrame, cats: list[str], cls: str) -> DataFrame:
    """(column, category, class, n, category_total); column names that do not exist are skipped."""
    present = [c for c in cats if c in df.columns]
    counts = (
        df.select(q(cls).cast("string").alias("class"), *[q(c).cast("string").alias(c) for c in present])
        .unpivot(["class"], [q(c) for c in present], "column", "category")
        .where(F.col("category").isNotNull())
        .groupBy("column", "category", "class")
        .agg(F.count("*").alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy("column", "category"))
    return counts.withColumn("category_total", total).orderBy("column", F.desc("category_total"), "category", "class")


def crosstab_percent(df: DataFrame, cat: str, cls: str, classes: list | None = None) -> DataFrame:
    """Share of each class inside a category in percent; absent cells are 0."""
    counts = df.groupBy(q(cat).alias(cat), q(cls).alias(cls)).agg(F.count("*").alias("n"))
    if classes is None:
        found = bounded_rows(counts.select(cls).distinct().orderBy(cls))
        if found is None:
            raise ValueError(f"{cls!r} has too many values for a crosstab")
        classes = [r[0] for r in found]
    wide = counts.groupBy(cat).pivot(cls, classes).agg(F.sum("n")).fillna(0)
    total = reduce(lambda a, b: a + b, [q(str(c)) for c in classes])
    return wide.select(q(cat).alias(cat), *[(q(str(c)) * 100.0 / total).alias(f"pct_{c}") for c in classes])


def score_summary(scores: DataFrame, model: str = "model", score: str = "val_acc") -> DataFrame:
    """Quartiles per model and the best median of all models as a reference line."""
    quart = exact_percentiles(scores, [score], [0.25, 0.5, 0.75], [model]).select(
        model, *[F.col("q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    )
    return quart.withColumn("best_median", F.max("median").over(Window.partitionBy()))
