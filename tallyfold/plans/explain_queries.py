"""Calibrated scores of the line table, and what a given score of the orders owes to its columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.rounding import rounded
from tallyfold.functions.scalars import hash_key
from tallyfold.operators import calibrate, explain
from tallyfold.operators.metrics import probability_metrics
from tallyfold.plans.registry import query
from tallyfold.runtime import stage
from tallyfold.sources.tables import CENSUS_SQL, LINE_KEY, census, metrics_sql, table


def graded_scores(spark, sf_dir, models=("discount", "quantity", "shipped")):
    """(key, fold, y, model, p): three scores of a line, the last with about as many values as days."""
    p = {
        "discount": F.col("l_discount") * 10,
        "quantity": F.col("l_quantity") / 50,
        "shipped": F.datediff(F.col("l_shipdate"), F.lit("1990-01-01").cast("date")) / F.lit(5000.0),
    }
    rows = F.array(*[F.struct(F.lit(m).alias("model"), p[m].cast("double").alias("p")) for m in models])
    return table(spark, sf_dir, "lineitem").select(
        hash_key(7, *LINE_KEY).alias("key"), F.col("l_linenumber").alias("fold"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"), F.inline(rows),
    )


LINES_SQL = """
lines AS (
  SELECT md5(concat_ws('|', '7', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate)) AS key,
         l_linenumber AS fold, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
         l_discount * 10 AS discount, (l_quantity / 50)::DOUBLE AS quantity,
         date_diff('day', DATE '1990-01-01', l_shipdate::DATE) / 5000.0::DOUBLE AS shipped
  FROM lineitem),
graded AS (UNPIVOT lines ON {models} INTO NAME model VALUE p)
"""
ALL_SQL = LINES_SQL.format(models="discount, quantity, shipped")
TIED_SQL = LINES_SQL.format(models="discount, quantity")
# Isotonic regression in closed form: at each score the largest, over starts at or before it, of the smallest mean, over ends at or
# after it, of what lies between. All pairs of distinct scores: SQL for a check, not a plan.
MINIMAX_SQL = """
sums AS (SELECT *, row_number() OVER w AS i, sum(n) OVER w AS cn, sum(pos) OVER w AS cp FROM points
         WINDOW w AS (PARTITION BY {by} ORDER BY score)),
lows AS (SELECT {aby}, b.i, b.score, b.n, b.pos, min((b.cp - a.cp + a.pos)::DOUBLE / (b.cn - a.cn + a.n)) OVER (
           PARTITION BY {aby}, a.i ORDER BY b.i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS low
         FROM sums a JOIN sums b ON {same} AND a.i <= b.i),
fit AS (SELECT {by}, score, n, pos, max(low) AS value FROM lows GROUP BY ALL),
blocks AS (SELECT {by}, min(score) AS lo, max(score) AS hi, sum(n)::BIGINT AS n, sum(pos)::BIGINT AS pos, value FROM fit GROUP BY {by}, value)
"""
OTHERS_SQL = """
points AS (SELECT s.model, f.fold, s.p AS score, count(*) AS n, sum(s.y) AS pos
           FROM graded s JOIN (SELECT DISTINCT fold FROM graded) f ON s.fold <> f.fold GROUP BY ALL)
"""
ISOTONIC_SQL = f"""
{TIED_SQL}, {OTHERS_SQL},
{MINIMAX_SQL.format(by="model, fold", aby="a.model, a.fold", same="a.model = b.model AND a.fold = b.fold")},
steps AS (SELECT *, lead(lo) OVER w AS next_lo, lead(value) OVER w AS next_value, first(value) OVER w AS first_value
          FROM blocks WINDOW w AS (PARTITION BY model, fold ORDER BY lo)),
ends AS (SELECT model, fold, min_by(value, lo) AS lowest FROM blocks GROUP BY ALL),
isotonic AS (
  SELECT g.model, g.key, g.fold, g.y, g.p, CASE WHEN s.lo IS NULL THEN e.lowest WHEN g.p <= s.hi OR s.next_lo IS NULL THEN s.value
         ELSE s.value + (s.next_value - s.value) / (s.next_lo - s.hi) * (g.p - s.hi) END AS calibrated
  FROM graded g JOIN ends e USING (model, fold)
  ASOF LEFT JOIN steps s ON g.model = s.model AND g.fold = s.fold AND g.p >= s.lo)
"""
# Twelve full Newton steps from the best constant.
PLATT_SQL = f"""
{OTHERS_SQL},
goals AS (SELECT model, fold, sum(n)::BIGINT AS n, 1.0::DOUBLE / (sum(n) - sum(pos) + 2) AS t0, (sum(pos) + 1.0::DOUBLE) / (sum(pos) + 2) AS t1,
                 ((sum(n) - sum(pos)) * t0 + sum(pos) * t1) / sum(n) AS mean FROM points GROUP BY ALL),
newton AS (
  SELECT model, fold, 0 AS step, 0.0::DOUBLE AS a, ln(mean / (1 - mean)) AS b FROM goals
  UNION ALL
  SELECT model, fold, step, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab)
  FROM (SELECT model, fold, step + 1 AS step, a, b, sum(miss * score) AS ga, sum(miss) AS gb,
               sum(bend * score * score) AS haa, sum(bend * score) AS hab, sum(bend) AS hbb
        FROM (SELECT w.model, w.fold, w.step, w.a, w.b, x.score, 1.0::DOUBLE / (1 + exp(-(w.a * x.score + w.b))) AS q,
                     x.n * q - (x.pos * g.t1 + (x.n - x.pos) * g.t0) AS miss, x.n * q * (1 - q) AS bend
              FROM newton w JOIN points x USING (model, fold) JOIN goals g USING (model, fold) WHERE w.step < 12)
        GROUP BY model, fold, step, a, b)),
params AS (SELECT model, fold, a, b, n FROM newton JOIN goals USING (model, fold) WHERE step = 12)
"""


@query(
    "isotonic_blocks",
    f"""WITH {ALL_SQL}, points AS (SELECT model, p AS score, count(*) AS n, sum(y) AS pos FROM graded GROUP BY ALL),
    {MINIMAX_SQL.format(by="model", aby="a.model", same="a.model = b.model")}
    SELECT model, round(lo, 9) AS lo, round(hi, 9) AS hi, n, pos, row_number() OVER (PARTITION BY model ORDER BY lo) AS block,
           round(value, 9) AS value FROM blocks""",
)
def isotonic_blocks(spark, sf_dir):
    """The steps of a non-decreasing fit; ranges are short, so that seams are met at any size."""
    points = calibrate.score_points(graded_scores(spark, sf_dir), ["model"])
    blocks = calibrate.isotonic_blocks(points, ["model"], range_rows=500)
    return rounded(blocks.drop("next_lo", "next_value"))


@query("isotonic_scores", f"WITH {ISOTONIC_SQL} SELECT model, key, y, round(calibrated, 9) AS calibrated FROM isotonic")
def isotonic_scores(spark, sf_dir):
    """Every line scored by the isotonic fit of the other folds."""
    scores = graded_scores(spark, sf_dir, ("discount", "quantity"))
    return rounded(calibrate.cross_calibrated(scores, "isotonic", "fold", ["model"]).select("model", "key", "y", "calibrated"))


@query(
    "platt_params",
    f"""WITH RECURSIVE {ALL_SQL}, {PLATT_SQL}
    SELECT model, fold, round(a, 6) AS a, round(b, 6) AS b, n, TRUE AS flat, TRUE AS no_worse FROM params""",
)
def platt_params(spark, sf_dir):
    """Sigmoid fits per fold; ``flat``: the gradient vanishes, ``no_worse``: the loss is not above that of the best constant."""
    points = calibrate.complement_points(graded_scores(spark, sf_dir), "fold", ["model"])
    fits = calibrate.platt_fit(points, ["model", "fold"])
    flags = (F.col("gradient") < 1e-8).alias("flat"), (F.col("loss") <= F.col("prior_loss") * (1 + 1e-12)).alias("no_worse")
    return rounded(fits.select("model", "fold", "a", "b", "n", *flags), 6)


@query(
    "calibration_gain",
    f"""WITH RECURSIVE {ISOTONIC_SQL}, {PLATT_SQL.replace(OTHERS_SQL + ",", "")},
    every AS (
      SELECT model, 'raw' AS method, y, p FROM graded UNION ALL SELECT model, 'isotonic', y, calibrated FROM isotonic
      UNION ALL SELECT model, 'sigmoid', y, 1.0::DOUBLE / (1 + exp(-(a * p + b))) FROM graded JOIN params USING (model, fold)),
    safe AS (SELECT *, least(greatest(p, 2.220446049250313e-16::DOUBLE), 1.0::DOUBLE - 2.220446049250313e-16::DOUBLE) AS q FROM every)
    SELECT model, method, count(*) AS n, round(avg(CASE WHEN y = 1 THEN -ln(q) ELSE -ln(1.0::DOUBLE - q) END), 7) AS log_loss,
           round(avg((p - y) * (p - y)), 7) AS brier FROM safe GROUP BY model, method""",
)
def calibration_gain(spark, sf_dir):
    """Log loss and Brier score of raw scores and of both calibrations, each cross-fitted."""
    scores = stage(graded_scores(spark, sf_dir, ("discount", "quantity")), "graded")
    every = scores.select("model", F.lit("raw").alias("method"), "y", "p")
    for method in calibrate.METHODS:
        fitted = calibrate.cross_calibrated(scores, method, "fold", ["model"])
        every = every.unionByName(fitted.select("model", F.lit(method).alias("method"), "y", F.col("calibrated").alias("p")))
    return rounded(probability_metrics(every, ["model", "method"]), 7)


FEATURES = ["total", "balance", "gain", "status"]


def given_score(df):
    """A score with a kink, a missing value and a category: what it owes to each column is known."""
    total, balance, gain = F.col("total") / 500000.0, F.col("balance") / 10000.0, F.col("gain")
    lift = F.when(F.col("status") == "F", 0.25).when(F.col("status") == "O", 0.125).otherwise(0.0)
    p = 0.5 * total + F.when(gain > 0, 0.25).otherwise(0.0) + F.coalesce(0.125 * balance, F.lit(0.0625)) + lift
    return df.withColumn("p", p).withColumn("label", (p >= 0.5).cast("int"))


GIVEN_SQL = """0.5::DOUBLE * ({total} / 500000.0::DOUBLE) + CASE WHEN {gain} > 0 THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END
  + coalesce(0.125::DOUBLE * ({balance} / 10000.0::DOUBLE), 0.0625::DOUBLE)
  + CASE {status} WHEN 'F' THEN 0.25::DOUBLE WHEN 'O' THEN 0.125::DOUBLE ELSE 0.0::DOUBLE END"""
OWN = {c: f"a.{c}" for c in FEATURES}


def _swapped_sql(source: str) -> str:
    """The score with each feature in turn taken from ``source``."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, repeat, y, ({GIVEN_SQL.format(**OWN | {c: f'b.{c}'})} >= 0.5)::INT AS label FROM {source}" for c in FEATURES
    )


# The rows with the score's own classes, every seventh of them wrong: a target that the columns explain.
TARGET_SQL = f"seen AS (SELECT id, {', '.join(FEATURES)}, CASE WHEN id % 7 = 0 THEN 0 ELSE ({GIVEN_SQL.format(**OWN)} >= 0.5)::INT END AS y FROM census a)"


def explained(spark, sf_dir):
    scored = given_score(census(spark, sf_dir))
    return scored.select("id", *FEATURES, F.when(F.col("id") % 7 == 0, 0).otherwise(F.col("label")).alias("y"))


@query(
    "permutation_importance",
    f"""WITH {CENSUS_SQL}, {TARGET_SQL},
    taking AS (SELECT s.*, repeat, row_number() OVER (PARTITION BY repeat ORDER BY md5(concat_ws('|', '42|take', repeat, id))) AS rank
               FROM seen s, range(1, 4) r(repeat)),
    giving AS (SELECT s.*, repeat, row_number() OVER (PARTITION BY repeat ORDER BY md5(concat_ws('|', '42|give', repeat, id))) AS rank
               FROM seen s, range(1, 4) r(repeat)),
    rows AS (SELECT a.repeat, a.y, a AS a, b AS b FROM taking a JOIN giving b USING (repeat, rank)),
    scored AS ({_swapped_sql("rows")} UNION ALL SELECT '', 0, y, ({GIVEN_SQL.format(**OWN)} >= 0.5)::INT FROM seen a),
    cells AS (SELECT feature, repeat, count(*) FILTER (WHERE y=1 AND label=1) AS tp, count(*) FILTER (WHERE y=0 AND label=1) AS fp,
                count(*) FILTER (WHERE y=0 AND label=0) AS tn, count(*) FILTER (WHERE y=1 AND label=0) AS fn FROM scored GROUP BY ALL),
    measured AS ({metrics_sql("cells", "feature, repeat")}),
    base AS (SELECT mcc AS baseline FROM measured WHERE feature = '')
    SELECT feature, round(first(baseline), 7) AS baseline, round(avg(baseline - mcc), 7) AS importance,
           round(stddev_pop(baseline - mcc), 7) AS importance_std
    FROM measured, base WHERE feature <> '' GROUP BY feature""",
)
def permutation_importance(spark, sf_dir):
    return rounded(explain.permutation_importance(explained(spark, sf_dir), ["id"], FEATURES, given_score, "mcc", 3), 7)


GRID_SQL = """
ends AS (SELECT '{c}' AS feature, quantile_cont({c}, 0.05) AS low, quantile_cont({c}, 0.95) AS high FROM seen),
steps AS (SELECT feature, i::INTEGER AS point, low + (high - low) / 19 * i AS value FROM ends, range(20) t(i))
"""


def _dependence_sql() -> str:
    selects, withs = [], []
    for c in ("total", "balance"):
        withs.append(GRID_SQL.format(c=c).replace("ends AS", f"ends_{c} AS").replace("steps AS", f"steps_{c} AS").replace("FROM ends,", f"FROM ends_{c},"))
        score = GIVEN_SQL.format(**OWN | {c: "g.value"})
        selects.append(
            f"SELECT feature, point, round(value, 7) AS value, NULL::VARCHAR AS category, count(*) AS n, round(avg({score}), 7) AS mean_p "
            f"FROM seen a, steps_{c} g GROUP BY ALL"
        )
    withs.append("kinds AS (SELECT status, (row_number() OVER (ORDER BY status) - 1)::INTEGER AS point FROM (SELECT DISTINCT status FROM seen))")
    score = GIVEN_SQL.format(**OWN | {"status": "g.status"})
    selects.append(
        f"SELECT 'status', point, NULL::DOUBLE, g.status, count(*), round(avg({score}), 7) FROM seen a, kinds g GROUP BY ALL"
    )
    return f"WITH {CENSUS_SQL}, {TARGET_SQL}, {', '.join(withs)} {' UNION ALL '.join(selects)}"


@query("partial_dependence", _dependence_sql())
def partial_dependence(spark, sf_dir):
    rows = explained(spark, sf_dir)
    grids = explain.feature_grids(rows, ["total", "balance", "status"], 20)
    return rounded(explain.partial_dependence(rows, FEATURES, given_score, grids), 7)
