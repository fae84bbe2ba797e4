"""Fit-on-train feature transformations, shown as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.rounding import rounded
from tallyfold.operators import clean, features, split
from tallyfold.plans.registry import query
from tallyfold.plans.split_queries import SPLIT_SQL
from tallyfold.runtime import stage
from tallyfold.sources.tables import census

NUMS = ["total", "balance", "gain"]
CATS = ["status", "segment"]
TRAIN_SQL = f"{SPLIT_SQL}, parts AS (SELECT c.*, h.split FROM census c JOIN halves h USING (id)), train AS (SELECT * FROM parts WHERE split = 'train')"


def halves(spark, sf_dir):
    """(train, all rows with split): the census-like frame, half of it for fitting."""
    frame = clean.encode_binary(clean.sentinel_to_null(census(spark, sf_dir)), "income").drop("income")
    parts = split.stratified_split(stage(frame, "census"), ["id"], "y")
    return parts.where("split = 'train'"), parts


@query(
    "median_impute",
    f"WITH {TRAIN_SQL}, m AS (SELECT median(balance) AS m FROM train) "
    "SELECT id, round(coalesce(balance, (SELECT m FROM m)), 6) AS balance FROM parts",
)
def median_impute(spark, sf_dir):
    train, rows = halves(spark, sf_dir)
    model = features.MedianImputer(cols=["balance"]).fit(train)
    return rounded(model.transform(rows).select("id", "balance"), 6)


@query(
    "mode_impute",
    f"WITH {TRAIN_SQL}, ms AS (SELECT status AS v FROM train WHERE status <> '?' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), "
    "mg AS (SELECT segment AS v FROM train WHERE segment <> '?' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) "
    "SELECT id, coalesce(nullif(status, '?'), (SELECT v FROM ms)) AS status, "
    "coalesce(nullif(segment, '?'), (SELECT v FROM mg)) AS segment FROM parts",
)
def mode_impute(spark, sf_dir):
    train, rows = halves(spark, sf_dir)
    return features.ModeImputer(cols=CATS).fit(train).transform(rows).select("id", *CATS)


def robust_sql(c: str) -> str:
    q = [f"(SELECT quantile_cont({c}::DOUBLE, {p}) FROM train)" for p in (0.25, 0.5, 0.75)]
    return f"round(({c} - {q[1]}) / CASE WHEN {q[2]} = {q[0]} THEN 1.0::DOUBLE ELSE {q[2]} - {q[0]} END, 7) AS {c}"


@query("robust_scale", f"WITH {TRAIN_SQL} SELECT id, {', '.join(robust_sql(c) for c in NUMS)} FROM parts")
def robust_scale(spark, sf_dir):
    train, rows = halves(spark, sf_dir)
    return rounded(features.ExactRobustScaler(cols=NUMS).fit(train).transform(rows).select("id", *NUMS), 7)


@query(
    "iqr_route",
    f"WITH {TRAIN_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(quantile_cont({c}::DOUBLE, 0.75) - quantile_cont({c}::DOUBLE, 0.25), 6) AS iqr,
        CASE WHEN quantile_cont({c}::DOUBLE, 0.75) = quantile_cont({c}::DOUBLE, 0.25) THEN 'quantile_normal' ELSE 'robust_scale' END AS route
        FROM train"""
        for c in NUMS
    ),
)
def iqr_route(spark, sf_dir):
    train, _ = halves(spark, sf_dir)
    return rounded(features.routing_table(train, NUMS), 6)


def _poly(coefs, x: str) -> str:
    acc = f"({coefs[0]}::DOUBLE)"
    for c in coefs[1:]:
        acc = f"({acc}*{x} + ({c}::DOUBLE))"
    return acc


def probit_sql(p: str) -> str:
    from tallyfold.functions import scalars as s

    r, lo, hi = f"(({p}-0.5)*({p}-0.5))", f"sqrt(-2.0*ln({p}))", f"sqrt(-2.0*ln(1.0::DOUBLE-{p}))"
    return (
        f"CASE WHEN {p} < {s.PROBIT_TAIL} THEN {_poly(s.PROBIT_TAIL_NUM, lo)}/{_poly(s.PROBIT_TAIL_DEN, lo)} "
        f"WHEN {p} > 1.0-{s.PROBIT_TAIL} THEN -{_poly(s.PROBIT_TAIL_NUM, hi)}/{_poly(s.PROBIT_TAIL_DEN, hi)} "
        f"ELSE {_poly(s.PROBIT_CENTRE_NUM, r)}*({p}-0.5)/{_poly(s.PROBIT_CENTRE_DEN, r)} END"
    )


def quantile_normal_sql(c: str) -> str:
    """Empirical CDF between break points (mean of both sides on ties), then the normal quantile."""
    return f"""
  n_{c} AS (SELECT count({c}) AS n, least(count({c}), 1000) AS m FROM train),
  s_{c} AS (SELECT {c}::DOUBLE AS v, row_number() OVER (ORDER BY {c}) - 1 AS r FROM train WHERE {c} IS NOT NULL),
  h_{c} AS (SELECT j, j*(n-1) // (m-1) AS lo, (j*(n-1) + m - 2) // (m-1) AS hi, (j*(n-1) % (m-1))::DOUBLE/(m-1) AS f,
            j::DOUBLE/(m-1) AS ref FROM n_{c}, LATERAL (SELECT unnest(range(m)) AS j) t),
  b_{c} AS (SELECT a.v + (b.v - a.v)*f AS v, ref FROM h_{c} JOIN s_{c} a ON a.r = lo JOIN s_{c} b ON b.r = hi),
  d_{c} AS (SELECT v, min(ref) AS rl, max(ref) AS rh, lead(v) OVER (ORDER BY v) AS nv, lead(min(ref)) OVER (ORDER BY v) AS nr
            FROM b_{c} GROUP BY v),
  e_{c} AS (SELECT min(v) AS lo, max(v) AS hi FROM d_{c}),
  x_{c} AS (SELECT DISTINCT {c}::DOUBLE AS x FROM parts WHERE {c} IS NOT NULL),
  p_{c} AS (SELECT x, CASE WHEN x - 1e-7 < lo THEN 0.0::DOUBLE WHEN x + 1e-7 > hi THEN 1.0::DOUBLE WHEN x = v THEN (rl + rh)/2
             ELSE rh + (nr - rh)*((x - v)/(nv - v)) END AS p
            FROM (SELECT * FROM x_{c} ASOF LEFT JOIN d_{c} ON x >= v), e_{c}),
  z_{c} AS (SELECT x, CASE WHEN p <= 1e-7 THEN -5.199337582605575 WHEN p >= 1.0 - 1e-7 THEN 5.199337582605575
             ELSE {probit_sql('p')} END AS z FROM p_{c})"""


@query(
    "quantile_normal",
    f"WITH {TRAIN_SQL}, {','.join(quantile_normal_sql(c) for c in NUMS)} SELECT id, round(zt.z, 5) AS total, round(zb.z, 5) AS balance, "
    "round(zg.z, 5) AS gain FROM parts LEFT JOIN z_total zt ON zt.x = total LEFT JOIN z_balance zb ON zb.x = balance "
    "LEFT JOIN z_gain zg ON zg.x = gain",
)
def quantile_normal(spark, sf_dir):
    train, rows = halves(spark, sf_dir)
    return rounded(features.QuantileNormal(cols=NUMS).fit(train).transform(rows).select("id", *NUMS), 5)


@query(
    "routed_scale",
    f"WITH {TRAIN_SQL}, {quantile_normal_sql('gain')} SELECT id, {robust_sql('total')}, round(z, 5) AS gain "
    "FROM parts LEFT JOIN z_gain ON x = gain",
)
def routed_scale(spark, sf_dir):
    train, rows = halves(spark, sf_dir)
    out = features.RoutedScaler(cols=["total", "gain"]).fit(train).transform(rows)
    return out.select("id", (F.round("total", 7) + 0.0).alias("total"), (F.round("gain", 5) + 0.0).alias("gain"))


@query(
    "onehot_long",
    f"WITH {TRAIN_SQL}, known AS (SELECT DISTINCT 'status_' || status AS feature FROM train WHERE status <> 'P' AND status <> '?' "
    "UNION SELECT DISTINCT 'segment_' || segment FROM train WHERE segment <> '?'), "
    "hot AS (SELECT id, 'status_' || status AS feature FROM parts UNION ALL SELECT id, 'segment_' || segment FROM parts) "
    "SELECT id, feature FROM hot JOIN known USING (feature)",
)
def onehot_long(spark, sf_dir):
    """Fitted without status P, so that rows with it show what happens to unseen values."""
    train, rows = halves(spark, sf_dir)
    known = train.where("status <> 'P' or status is null").dropna(subset=["status"])
    segments = train.where("segment is not null")
    parts = [
        features.onehot_long(rows, "id", ["status"], known),
        features.onehot_long(rows, "id", ["segment"], segments),
    ]
    return clean.stack_rows(parts)


@query(
    "feature_names",
    f"WITH {TRAIN_SQL}, f AS (SELECT 0 AS g, 'total' AS feature UNION ALL SELECT 1, 'balance' UNION ALL SELECT 2, 'gain' "
    "UNION ALL SELECT DISTINCT 3, 'status_' || status FROM train WHERE status <> '?' "
    "UNION ALL SELECT DISTINCT 4, 'segment_' || segment FROM train WHERE segment <> '?') "
    "SELECT (row_number() OVER (ORDER BY g, feature) - 1)::INTEGER AS idx, feature FROM f",
)
def feature_names(spark, sf_dir):
    train, _ = halves(spark, sf_dir)
    model = features.preprocessing(NUMS, CATS).fit(train)
    return features.feature_table(spark, features.feature_names(model, NUMS, CATS))


@query(
    "encoded_matrix",
    f"""WITH {TRAIN_SQL},
    ms AS (SELECT status AS v FROM train WHERE status <> '?' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    mg AS (SELECT segment AS v FROM train WHERE segment <> '?' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    med AS (SELECT median(balance) AS m FROM train),
    filled AS (SELECT id, coalesce(balance, (SELECT m FROM med)) AS balance, total, split,
                coalesce(nullif(status, '?'), (SELECT v FROM ms)) AS status,
                coalesce(nullif(segment, '?'), (SELECT v FROM mg)) AS segment FROM parts),
    q AS (SELECT quantile_cont(balance, 0.25) AS b1, quantile_cont(balance, 0.5) AS b2, quantile_cont(balance, 0.75) AS b3,
                 quantile_cont(total, 0.25) AS t1, quantile_cont(total, 0.5) AS t2, quantile_cont(total, 0.75) AS t3
          FROM filled WHERE split = 'train')
    SELECT id, round((total - t2)/(t3 - t1), 7) AS total, round((balance - b2)/(b3 - b1), 7) AS balance,
           status, segment, 2::BIGINT AS ones FROM filled, q""",
)
def encoded_matrix(spark, sf_dir):
    """The whole preprocessing chain, read back from the assembled vector."""
    from pyspark.ml.functions import vector_to_array

    train, rows = halves(spark, sf_dir)
    nums = ["total", "balance"]
    model = features.preprocessing(nums, CATS).fit(train)
    names = features.feature_names(model, nums, CATS)
    out = model.transform(rows).withColumn("v", vector_to_array("features"))

    def value_of(col):
        slots = [(i, n[len(col) + 1 :]) for i, n in enumerate(names) if n.startswith(f"{col}_")]
        return F.coalesce(*[F.when(F.col("v")[i] == 1.0, v) for i, v in slots])

    ones = F.aggregate(F.slice("v", 3, len(names)), F.lit(0.0), lambda a, x: a + x).cast("long")
    return out.select(
        "id",
        (F.round(F.col("v")[0], 7) + 0.0).alias("total"),
        (F.round(F.col("v")[1], 7) + 0.0).alias("balance"),
        value_of("status").alias("status"),
        value_of("segment").alias("segment"),
        ones.alias("ones"),
    )


@query(
    "class_weights",
    f"WITH {TRAIN_SQL} SELECT y, count(*) AS n, round(sum(count(*)) OVER ()::DOUBLE / (2 * count(*)), 9) AS weight FROM train GROUP BY y",
)
def class_weights(spark, sf_dir):
    train, _ = halves(spark, sf_dir)
    return rounded(features.class_weights(train))


@query(
    "baseline_metrics",
    f"""WITH {TRAIN_SQL}, top AS (SELECT y FROM train GROUP BY y ORDER BY count(*) DESC, y LIMIT 1)
    SELECT 0.0::DOUBLE AS mcc, round(avg((p.y = t.y)::INT::DOUBLE), 9) AS accuracy, 0.5::DOUBLE AS balanced_accuracy
    FROM parts p, top t WHERE split = 'test'""",
)
def baseline_metrics(spark, sf_dir):
    from tallyfold.operators.metrics import binary_metrics
    from tallyfold.plans.models import fit_model, score_rows

    train, rows = halves(spark, sf_dir)
    scored = score_rows(fit_model("DummyMostFreq", train), rows.where("split = 'test'").select("id", "y"))
    return rounded(binary_metrics(scored, only=("mcc", "accuracy", "balanced_accuracy")).drop("tp", "fp", "tn", "fn"))
