"""Feature stages: fitted on training rows, applied to any frame, usable in ``pyspark.ml.Pipeline``.

The stages here cover what the built-in ones do differently from the behaviour wanted: exact
medians and quartiles, scaling that leaves zero-IQR columns unscaled, mode imputation of strings
and the quantile-to-normal map. Encoding and assembly use the built-in stages.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import Bucketizer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.scalars import clip, probit, probit_argument
from tallyfold.operators.clean import mode_values
from tallyfold.operators.order import exact_percentiles, ordered_cumsum
from tallyfold.operators.profile import q
from tallyfold.runtime import local_frame, lookup_join

# Fixed value: probabilities beyond this distance from 0 and 1 are clipped before the normal map.
TAIL = 1e-7
# Fixed value: the normal quantile at TAIL.
TAIL_QUANTILE = 5.199337582605575
MAX_QUANTILES = 1000
_BREAKS = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("__bucket", "__at", "__low", "__high", "__next_at", "__next_low")]
)


class _ColumnStage(Params, DefaultParamsReadable, DefaultParamsWritable):
    cols = Param(Params._dummy(), "cols", "columns replaced in place")
    state = Param(Params._dummy(), "state", "fitted values")

    def _columns(self) -> list[str]:
        return list(self.getOrDefault("cols"))


class _ColumnModel(Model, _ColumnStage):
    @keyword_only
    def __init__(self, *, cols=None, state=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _expr(self, name: str, x: Column, fitted) -> Column:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = self.getOrDefault("state")
        return dataset.withColumns({c: self._expr(c, q(c), fitted[c]) for c in self._columns() if c in fitted})


class _ColumnEstimator(Estimator, _ColumnStage):
    model: type[_ColumnModel]

    @keyword_only
    def __init__(self, *, cols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _measure(self, dataset: DataFrame) -> dict:
        raise NotImplementedError

    def _fit(self, dataset: DataFrame) -> _ColumnModel:
        return self._copyValues(self.model(cols=self._columns(), state=self._measure(dataset)))


def quartiles(df: DataFrame, cols: list[str]) -> dict[str, list[float]]:
    """Column -> [q1, median, q3], exact."""
    return {r["column"]: list(r["q"]) for r in exact_percentiles(df, cols, [0.25, 0.5, 0.75]).collect()}


class MedianImputerModel(_ColumnModel):
    def _expr(self, name, x, fitted):
        value = x.cast("double")
        return F.when(value.isNull() | F.isnan(value), F.lit(fitted)).otherwise(value)


class MedianImputer(_ColumnEstimator):
    """Nulls and NaN become the training median."""

    model = MedianImputerModel

    def _measure(self, dataset):
        return {r["column"]: r["q"][0] for r in exact_percentiles(dataset, self._columns(), [0.5]).collect()}


class ModeImputerModel(_ColumnModel):
    def _expr(self, name, x, fitted):
        return F.coalesce(x, F.lit(fitted))


class ModeImputer(_ColumnEstimator):
    """Null strings become the most frequent training value, the smallest on ties."""

    model = ModeImputerModel

    def _measure(self, dataset):
        return mode_values(dataset, self._columns())


def _robust(x: Column, quart: list[float]) -> Column:
    low, mid, high = quart
    spread = high - low
    return (x.cast("double") - F.lit(mid)) / F.lit(spread if spread != 0 else 1.0)


class RobustScalerModel(_ColumnModel):
    def _expr(self, name, x, fitted):
        return _robust(x, fitted)


class ExactRobustScaler(_ColumnEstimator):
    """(x - median) / IQR; a zero IQR divides by 1."""

    model = RobustScalerModel

    def _measure(self, dataset):
        return quartiles(dataset, self._columns())


def even_quantiles(df: DataFrame, cols: list[str], n_quantiles: int = MAX_QUANTILES) -> dict[str, list[float]]:
    """Exact values at min(n_quantiles, n) evenly spaced probabilities per column.

    Distinct values are counted, accumulated in two levels, and each value row works out by
    arithmetic which of the wanted ranks it covers.
    """
    long = (
        df.select(*[q(c).cast("double").alias(c) for c in cols])
        .unpivot([], [q(c) for c in cols], "column", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )
    counts = long.groupBy("column", "value").agg(F.count("*").alias("cnt"))
    cum = ordered_cumsum(counts, "value", ["cnt"], ["column"])
    totals = cum.groupBy("column").agg(F.sum("cnt").alias("n"))
    rows = (
        lookup_join(cum, totals, ["column"], "inner")
        .withColumn("m1", F.least(F.col("n"), F.lit(n_quantiles)) - 1)
        .withColumn("n1", F.greatest(F.col("n") - 1, F.lit(1)))
        .withColumn("before", F.col("cum_cnt") - F.col("cnt"))
    )
    floor_first = F.expr("(before * m1 + n1 - 1) div n1")
    floor_last = F.expr("least((cum_cnt * m1 + n1 - 1) div n1 - 1, m1)")
    ceil_first = F.expr("if(before = 0, 0, ((before - 1) * m1) div n1 + 1)")
    ceil_last = F.expr("least(((cum_cnt - 1) * m1) div n1, m1)")

    def covered(first: Column, last: Column, side: str) -> Column:
        js = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(js, lambda j: F.struct(j.alias("j"), F.lit(side).alias("side")))

    picks = (
        rows.withColumn("hit", F.explode(F.concat(covered(floor_first, floor_last, "lo"), covered(ceil_first, ceil_last, "hi"))))
        .groupBy("column", "hit.j")
        .agg(
            F.max(F.when(F.col("hit.side") == "lo", F.col("value"))).alias("lo"),
            F.max(F.when(F.col("hit.side") == "hi", F.col("value"))).alias("hi"),
            F.first("n1").alias("n1"),
            F.first("m1").alias("m1"),
        )
        .collect()  # at most n_quantiles rows per column
    )
    out: dict[str, list[float]] = {}
    for r in sorted(picks, key=lambda r: (r["column"], r["j"])):
        position = r["j"] * r["n1"] / r["m1"] if r["m1"] else 0.0
        out.setdefault(r["column"], []).append(r["lo"] + (r["hi"] - r["lo"]) * (position - int(position)))
    return out


def break_points(points: list[float]) -> list[tuple]:
    """Rows (bucket, at, low, high, next_at, next_low) per distinct break point.

    ``bucket`` counts the distinct points at or below a value; tied points keep their first and last
    reference probability.
    """
    last = len(points) - 1
    values, low, high = [], [], []
    for i, p in enumerate(points):
        ref = i / last if last else 0.0
        if values and values[-1] == p:
            high[-1] = ref
        else:
            values.append(p), low.append(ref), high.append(ref)
    following = [*range(1, len(values)), len(values) - 1]
    return [(float(i + 1), values[i], low[i], high[i], values[j], low[j]) for i, j in enumerate(following)]


def quantile_position(x: Column, first: float, final: float) -> Column:
    """Empirical CDF of ``x`` from its break-point row; the mean of both sides on a tie."""
    share = (x - F.col("__at")) / (F.col("__next_at") - F.col("__at"))
    inner = F.when(x == F.col("__at"), (F.col("__low") + F.col("__high")) / 2).otherwise(
        F.col("__high") + (F.col("__next_low") - F.col("__high")) * share
    )
    return (
        F.when(x.isNull() | F.isnan(x), F.lit(None).cast("double"))
        .when(x - TAIL < first, 0.0)
        .when(x + TAIL > final, 1.0)
        .otherwise(inner)
    )


def with_normal_score(df: DataFrame, p: str, out: str) -> DataFrame:
    """Add ``out``: the normal quantile of a probability, tails clipped. Steps that are used more than once are columns."""
    stepped = df.withColumn("__arg", probit_argument(p)).withColumn("__z", probit(p, "__arg"))
    score = (
        F.when(F.col(p) <= TAIL, -TAIL_QUANTILE).when(F.col(p) >= 1 - TAIL, TAIL_QUANTILE)
        .otherwise(clip(F.col("__z"), -TAIL_QUANTILE, TAIL_QUANTILE))
    )
    return stepped.withColumn(out, score)


class QuantileNormalModel(_ColumnModel):
    def _transform(self, dataset):
        fitted = self.getOrDefault("state")
        out, names = dataset, dataset.columns
        for c in self._columns():
            points = fitted.get(c)
            if not points:
                continue
            rows = break_points(points)
            splits = [float("-inf"), *[r[1] for r in rows], float("inf")]
            table = local_frame(dataset.sparkSession, rows, _BREAKS)
            # Bucketizer searches the break points inside the JVM; their rows, at most
            # MAX_QUANTILES of them, come in by a broadcast join.
            out = Bucketizer(splits=splits, inputCol="__x", outputCol="__bucket", handleInvalid="keep").transform(
                out.withColumn("__x", q(c).cast("double"))
            )
            position = quantile_position(F.col("__x"), points[0], points[-1])
            # The position is its own column: the normal map refers to it many times.
            out = lookup_join(out, table, ["__bucket"], "left").withColumn("__p", position)
            out = with_normal_score(out, "__p", c).select(*[q(n) for n in names])
        return out


class QuantileNormal(_ColumnEstimator):
    """Map each column to a normal distribution through its empirical quantiles."""

    model = QuantileNormalModel

    def _measure(self, dataset):
        return even_quantiles(dataset, self._columns())


def route_by_iqr(df: DataFrame, cols: list[str]) -> tuple[list[str], list[str]]:
    """(zero-IQR columns, the others) on the training frame."""
    quart = quartiles(df, cols)
    zero = [c for c in cols if c in quart and quart[c][2] - quart[c][0] == 0]
    return zero, [c for c in cols if c not in zero]


class RoutedScaler(_ColumnEstimator):
    """Robust scaling, but the quantile-to-normal map where the IQR is zero."""

    def _fit(self, dataset):
        from pyspark.ml import PipelineModel

        zero, spread = route_by_iqr(dataset, self._columns())
        stages = []
        if zero:
            stages.append(QuantileNormal(cols=zero).fit(dataset))
        if spread:
            stages.append(ExactRobustScaler(cols=spread).fit(dataset))
        return PipelineModel(stages)


def routing_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, iqr, route)."""
    rows = exact_percentiles(df, cols, [0.25, 0.75])
    iqr = F.col("q")[1] - F.col("q")[0]
    return rows.select(
        "column", iqr.alias("iqr"), F.when(iqr == 0, "quantile_normal").otherwise("robust_scale").alias("route")
    )


def index_name(col: str) -> str:
    return f"__idx_{col}"


def onehot_name(col: str) -> str:
    return f"__hot_{col}"


def onehot_stages(cats: list[str]) -> list:
    """Sorted categories, one slot each; values unseen in training give all zeros.

    "keep" appends a slot for unseen values and ``dropLast`` removes exactly that slot.
    """
    index = [index_name(c) for c in cats]
    return [
        StringIndexer(inputCols=cats, outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=index, outputCols=[onehot_name(c) for c in cats], dropLast=True),
    ]


def preprocessing(nums: list[str], cats: list[str], scaler: str = "robust", out: str = "features") -> Pipeline:
    """Numeric chain and categorical chain, assembled numeric first."""
    scalers = {"robust": ExactRobustScaler, "routed": RoutedScaler, "quantile_normal": QuantileNormal, "none": None}
    if scaler not in scalers:
        raise ValueError(f"unknown scaler {scaler!r}")
    stages: list = []
    if nums:
        stages.append(MedianImputer(cols=nums))
        if scalers[scaler]:
            stages.append(scalers[scaler](cols=nums))
    if cats:
        stages += [ModeImputer(cols=cats), *onehot_stages(cats)]
    stages.append(VectorAssembler(inputCols=[*nums, *[onehot_name(c) for c in cats]], outputCol=out))
    return Pipeline(stages=stages)


def feature_names(model, nums: list[str], cats: list[str]) -> list[str]:
    """Names of the assembled slots: numeric columns, then ``col_value`` per category."""
    labels = [values for s in _leaves(model) if hasattr(s, "labelsArray") for values in s.labelsArray]
    return [*nums, *[f"{c}_{v}" for c, values in zip(cats, labels) for v in values]]


def feature_table(spark, names: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "idx int, feature string")


def _leaves(model):
    for stage in getattr(model, "stages", [model]):
        if hasattr(stage, "stages"):
            yield from _leaves(stage)
        else:
            yield stage


def onehot_long(df: DataFrame, key: str, cats: list[str], fitted_on: DataFrame) -> DataFrame:
    """(key, feature) for every slot that is 1."""
    model = Pipeline(stages=onehot_stages(cats)).fit(fitted_on)
    names = [[f"{c}_{v}" for v in values] for c, values in zip(cats, model.stages[0].labelsArray)]

    def present(col: str, labels: list[str]) -> Column:
        hot = vector_to_array(q(onehot_name(col)))
        marked = F.transform(hot, lambda x, i: F.when(x == 1.0, F.get(F.lit(labels), i.cast("int"))))
        return F.filter(marked, lambda name: name.isNotNull())

    slots = [present(c, n) for c, n in zip(cats, names)]
    return model.transform(df).select(key, F.explode(F.concat(*slots)).alias("feature"))


def class_weights(df: DataFrame, y: str = "y") -> DataFrame:
    """(y, n, weight) with weight = rows / (classes * rows of the class)."""
    counts = df.groupBy(y).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t"), F.count("*").alias("k")).first()
    return counts.withColumn("weight", F.lit(float(total["t"])) / (F.lit(total["k"]) * F.col("n")))


def with_class_weight(df: DataFrame, y: str = "y", out: str = "weight") -> DataFrame:
    weights = class_weights(df, y).collect()  # one row per class
    table = local_frame(df.sparkSession, [(r[y], float(r["weight"])) for r in weights], df.select(y, F.lit(0.0).alias(out)).schema)
    return lookup_join(df, table, [y], "left")
