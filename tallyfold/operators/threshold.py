"""Decision thresholds: one-pass sweeps, the best cut per metric and before/after tables."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.confusion import CELLS, DEFAULT_COSTS, LABEL_METRICS, cell_counts, label_metrics, objective_metric
from tallyfold.operators.clean import best_row
from tallyfold.runtime import lookup_join

TUNABLE = ("mcc", "f1", "balanced_accuracy", "cost_benefit")


def grid_value(i: Column, points: int) -> Column:
    """The i-th of evenly spaced thresholds over [0, 1], as i * step like the usual linspace."""
    last = points - 1
    return F.when(i == last, 1.0).otherwise(i * F.lit(1.0 / last))


def grid_slot(p: Column, points: int) -> Column:
    """Index of the highest grid point <= p; -1 below the grid or for null.

    ``floor`` gives a first guess, which comparing with the neighbouring grid values corrects.
    """
    last = points - 1
    guess = F.least(F.greatest(F.floor(p * last), F.lit(0)), F.lit(last)).cast("int")
    up = F.least(guess + 1, F.lit(last))
    slot = (
        F.when((up > guess) & (grid_value(up, points) <= p), up)
        .when(grid_value(guess, points) <= p, guess)
        .otherwise(guess - 1)
    )
    return F.when(p.isNull() | F.isnan(p), -1).otherwise(slot)


def threshold_sweep(
    scores: DataFrame, points: int = 101, by: list[str] | None = None, costs=DEFAULT_COSTS,
    only: tuple[str, ...] = LABEL_METRICS, y: str = "y", p: str = "p",
) -> DataFrame:
    """Label metrics of ``p >= t`` at every grid point, from one scan.

    Rows are binned to grid slots and summed (at most one row per slot and group leaves the scan);
    running sums over the slots give the counts at every threshold.
    """
    by = list(by or [])
    slots = scores.groupBy(*by, grid_slot(F.col(p), points).alias("slot")).agg(
        F.sum((F.col(y) == 1).cast("long")).alias("pos"), F.sum((F.col(y) == 0).cast("long")).alias("neg")
    )
    # One map of at most ``points`` slots per group, so that empty thresholds exist too.
    packed = slots.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("slot", F.struct("pos", "neg")))).alias("m"),
        F.sum("pos").alias("p_all"),
        F.sum("neg").alias("n_all"),
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("slot")
    spread = packed.select(*by, "m", "p_all", "n_all", every).withColumn("threshold", grid_value(F.col("slot"), points))
    at = F.element_at("m", F.col("slot"))
    w = Window.partitionBy(*by).orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, 0)
    cells = spread.select(
        *by,
        "threshold",
        F.sum(F.coalesce(at["pos"], F.lit(0))).over(w).alias("tp"),
        F.sum(F.coalesce(at["neg"], F.lit(0))).over(w).alias("fp"),
        "p_all",
        "n_all",
    ).withColumns({"fn": F.col("p_all") - F.col("tp"), "tn": F.col("n_all") - F.col("fp")})
    return cells.select(*by, "threshold", *CELLS, *label_metrics(costs=costs, only=only).values())


def best_threshold(sweep: DataFrame, by: list[str] | None = None, metrics: tuple[str, ...] = TUNABLE) -> DataFrame:
    """(by..., metric, threshold, value): the lowest threshold wins a tie."""
    by = list(by or [])
    long = sweep.unpivot([*by, "threshold"], list(metrics), "metric", "value")
    return best_row(long, "value", "threshold", [*by, "metric"])


def chosen_threshold(best: DataFrame, metric: str = "auto", objective: str = "mcc", default: float = 0.5) -> float:
    """Threshold for a metric; "auto" follows the tuning objective, an unknown metric gives the default."""
    name = objective if metric == "auto" else metric
    row = best.where(F.col("metric") == name).select("threshold").first()
    return default if row is None else row["threshold"]


def threshold_compare(
    scores: DataFrame, best: DataFrame, by: list[str], metric: str = "mcc", default: float = 0.5, costs=DEFAULT_COSTS
) -> DataFrame:
    """(by..., metric, at_default, at_best, difference) with both labellings counted in one scan."""
    cut = best.where(F.col("metric") == objective_name(metric)).select(*by, F.col("threshold").alias("cut"))
    both = lookup_join(scores, cut, by, "inner")
    both = both.withColumns({"l0": (F.col("p") >= default).cast("int"), "l1": (F.col("p") >= F.col("cut")).cast("int")})
    cells = both.groupBy(*by, "cut").agg(*cell_counts("y", "l0", "_0"), *cell_counts("y", "l1", "_1"))
    a = label_metrics("tp_0", "fp_0", "tn_0", "fn_0", costs)
    b = label_metrics("tp_1", "fp_1", "tn_1", "fn_1", costs)
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), a[m].alias("at_default"), b[m].alias("at_best")) for m in LABEL_METRICS])
    return (
        cells.select(*by, F.col("cut").alias("threshold"), F.inline(rows))
        .withColumn("difference", F.col("at_best") - F.col("at_default"))
    )


def objective_name(metric: str) -> str:
    return metric if metric in TUNABLE else objective_metric(metric)


class ThresholdLabel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """label = 1 where the positive probability is at least the threshold; probabilities stay as they are."""

    inputCol = Param(Params._dummy(), "inputCol", "probability column")
    outputCol = Param(Params._dummy(), "outputCol", "label column")
    threshold = Param(Params._dummy(), "threshold", "decision threshold")

    @keyword_only
    def __init__(self, *, inputCol="p", outputCol="label", threshold=0.5):
        super().__init__()
        self._setDefault(inputCol="p", outputCol="label", threshold=0.5)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p, t = self.getOrDefault(self.inputCol), self.getOrDefault(self.threshold)
        return dataset.withColumn(self.getOrDefault(self.outputCol), (F.col(p) >= t).cast("int"))
