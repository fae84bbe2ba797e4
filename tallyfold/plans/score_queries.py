"""Metrics, curves, threshold and calibration tables of the score frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.rounding import rounded
from tallyfold.operators import clean, curves, diagnose, metrics, threshold
from tallyfold.plans.registry import query
from tallyfold.sources.tables import SCORES_SQL, line_scores, metrics_sql

CELLS_SQL = """
cells AS (SELECT {keys}
  count(*) FILTER (WHERE y=1 AND label=1) AS tp, count(*) FILTER (WHERE y=0 AND label=1) AS fp,
  count(*) FILTER (WHERE y=0 AND label=0) AS tn, count(*) FILTER (WHERE y=1 AND label=0) AS fn
  FROM scores {group})
"""
# Running counts per distinct score, best score first.
STEPS_SQL = """
one AS (SELECT model, p AS score, sum(y) AS pos, sum(1-y) AS neg FROM scores GROUP BY model, p),
steps AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
            sum(pos) OVER (PARTITION BY model) AS p_all, sum(neg) OVER (PARTITION BY model) AS n_all,
            lead(pos) OVER o AS next_pos, lead(neg) OVER o AS next_neg
          FROM one
          WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING),
                 o AS (PARTITION BY model ORDER BY score DESC))
"""
SWEEP_CELLS_SQL = """
grid AS (SELECT CASE WHEN i = {last} THEN 1.0::DOUBLE ELSE i * (1.0::DOUBLE/{last}) END AS threshold
         FROM range({last} + 1) t(i)),
hist AS (SELECT model, p, sum(y) AS pos, sum(1-y) AS neg FROM scores GROUP BY model, p),
cells AS (SELECT model, threshold,
   CAST(sum(CASE WHEN p >= threshold THEN pos ELSE 0 END) AS BIGINT) AS tp,
   CAST(sum(CASE WHEN p >= threshold THEN neg ELSE 0 END) AS BIGINT) AS fp,
   CAST(sum(CASE WHEN p < threshold THEN neg ELSE 0 END) AS BIGINT) AS tn,
   CAST(sum(CASE WHEN p < threshold THEN pos ELSE 0 END) AS BIGINT) AS fn
  FROM hist, grid GROUP BY model, threshold)
"""
TUNABLE_SQL = " UNION ALL ".join(
    f"SELECT model, '{m}' AS metric, threshold, {m} AS value FROM sweep" for m in threshold.TUNABLE
)


@query(
    "confusion",
    f"WITH {SCORES_SQL} SELECT a.v AS y_true, b.v AS y_pred, count(s.y) AS n FROM (VALUES (0),(1)) a(v) "
    "CROSS JOIN (VALUES (0),(1)) b(v) LEFT JOIN scores s ON s.y = a.v AND s.label = b.v GROUP BY a.v, b.v",
)
def confusion(spark, sf_dir):
    return metrics.confusion_matrix(line_scores(spark, sf_dir))


@query(
    "binary_metrics",
    f"WITH {SCORES_SQL}, {CELLS_SQL.format(keys='model,', group='GROUP BY model')} {metrics_sql('cells', 'model')}",
)
def binary_metrics(spark, sf_dir):
    return rounded(metrics.binary_metrics(line_scores(spark, sf_dir), ["model"]))


FOLD_SQL = (
    f"{SCORES_SQL}, {CELLS_SQL.format(keys='model, fold,', group='GROUP BY model, fold')}, "
    f"labelled AS ({metrics_sql('cells', 'model, fold')})"
)
RANKING_FOLD_SQL = """
one AS (SELECT model, fold, p AS score, sum(y) AS pos, sum(1-y) AS neg FROM scores GROUP BY ALL),
steps AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
            sum(pos) OVER g AS p_all, sum(neg) OVER g AS n_all
          FROM one WINDOW w AS (PARTITION BY model, fold ORDER BY score DESC ROWS UNBOUNDED PRECEDING),
                          g AS (PARTITION BY model, fold)),
ranked AS (SELECT model, fold,
   round(sum(neg*(cum_pos - pos/2.0::DOUBLE)) / (first(p_all)::DOUBLE*first(n_all)), 9) AS roc_auc,
   round(sum(pos*(cum_pos::DOUBLE/(cum_pos+cum_neg))) / first(p_all)::DOUBLE, 9) AS pr_auc
  FROM steps GROUP BY model, fold)
"""


def fold_metric_frame(scores):
    labelled = metrics.binary_metrics(scores, ["model", "fold"])
    return labelled.join(curves.ranking_metrics(scores, ["model", "fold"]), ["model", "fold"])


@query(
    "fold_metrics",
    f"WITH {FOLD_SQL}, {RANKING_FOLD_SQL} SELECT l.*, roc_auc, pr_auc FROM labelled l JOIN ranked r USING (model, fold)",
)
def fold_metrics(spark, sf_dir):
    return rounded(fold_metric_frame(line_scores(spark, sf_dir)))


COMPARED = ("mcc", "accuracy", "precision", "recall", "f1", "balanced_accuracy", "specificity", "cost_benefit")


@query(
    "model_comparison",
    f"WITH {FOLD_SQL} SELECT model, "
    + ", ".join(f"round(avg({m}), 6) AS mean_{m}, round(stddev({m}), 6) AS std_{m}" for m in COMPARED)
    + " FROM labelled GROUP BY model",
)
def model_comparison(spark, sf_dir):
    per_fold = metrics.binary_metrics(line_scores(spark, sf_dir), ["model", "fold"])
    return rounded(diagnose.model_comparison(per_fold, list(COMPARED), "mcc"), 6)


@query(
    "best_model",
    f"WITH {FOLD_SQL}, m AS (SELECT model, avg(mcc) AS mean_mcc FROM labelled GROUP BY model) "
    "SELECT model, round(mean_mcc, 6) AS mean_mcc FROM m ORDER BY mean_mcc DESC, model LIMIT 1",
)
def best_model(spark, sf_dir):
    per_fold = metrics.binary_metrics(line_scores(spark, sf_dir), ["model", "fold"], only=("mcc",))
    means = per_fold.groupBy("model").agg(F.avg("mcc").alias("mean_mcc"))
    return rounded(clean.top_k(means, "mean_mcc", 1, "model"), 6)


@query(
    "top_models",
    f"WITH {FOLD_SQL}, m AS (SELECT model, avg(mcc) AS mean_mcc FROM labelled GROUP BY model) "
    "SELECT model, round(mean_mcc, 6) AS mean_mcc FROM m ORDER BY mean_mcc DESC, model LIMIT 2",
)
def top_models(spark, sf_dir):
    per_fold = metrics.binary_metrics(line_scores(spark, sf_dir), ["model", "fold"], only=("mcc",))
    means = per_fold.groupBy("model").agg(F.avg("mcc").alias("mean_mcc"))
    return rounded(clean.top_k(means, "mean_mcc", 2, "model"), 6)


OBJECTIVE_SQL = {"mcc": "mcc", "f1": "f1", "balanced_accuracy": "balanced_accuracy", "cost_benefit": "cost_benefit_raw"}


@query(
    "objectives",
    f"WITH {SCORES_SQL}, {CELLS_SQL.format(keys='model,', group='GROUP BY model')}, m AS ({metrics_sql('cells', 'model')}) "
    + " UNION ALL ".join(f"SELECT '{o}' AS name, model, {m} AS objective FROM m" for o, m in OBJECTIVE_SQL.items()),
)
def objectives(spark, sf_dir):
    one = metrics.binary_metrics(line_scores(spark, sf_dir), ["model"])
    pairs = F.array(
        *[F.struct(F.lit(o).alias("name"), F.col(metrics.objective_metric(o)).alias("objective")) for o in OBJECTIVE_SQL]
    )
    return rounded(one.select("model", F.inline(pairs)))


@query(
    "cost_benefit",
    f"WITH {SCORES_SQL}, {CELLS_SQL.format(keys='model,', group='GROUP BY model')}, m AS ({metrics_sql('cells', 'model')}) "
    "SELECT model, tp+fp+tn+fn AS n, cost_benefit_raw AS raw, cost_benefit AS normalised FROM m",
)
def cost_benefit(spark, sf_dir):
    counts = line_scores(spark, sf_dir).groupBy("model", F.col("y").alias("y_true"), F.col("label").alias("y_pred")).agg(
        F.count("*").alias("n")
    )
    values = {(0, 0): 5, (0, 1): -2, (1, 0): -10, (1, 1): 5}
    return rounded(metrics.cost_benefit(counts, values, ["model"]))


@query(
    "cost_benefit_multiclass",
    """WITH c AS (SELECT l_returnflag AS t, CASE WHEN l_discount < 0.03 THEN 'A' WHEN l_discount < 0.07 THEN 'N' ELSE 'R' END AS f
                  FROM lineitem),
       v(t, f, value) AS (VALUES ('A','A',3.0),('A','N',-1.0),('A','R',-4.0),('N','A',-2.0),('N','N',1.0),('N','R',0.0),
                                 ('R','A',-6.0),('R','N',-3.0),('R','R',8.0)),
       ends AS (SELECT t, max(value) FILTER (WHERE t = f) AS best, min(value) FILTER (WHERE t <> f) AS worst FROM v GROUP BY t),
       s AS (SELECT count(*) AS n, sum(value)::DOUBLE AS raw, sum(best)::DOUBLE AS best, sum(worst)::DOUBLE AS worst
             FROM c JOIN v USING (t, f) JOIN ends USING (t))
       SELECT n, round(raw/n, 9) AS raw, round(greatest(0, least(1, (raw-worst)/(best-worst))), 9) AS normalised FROM s""",
)
def cost_benefit_multiclass(spark, sf_dir):
    values = {
        ("A", "A"): 3, ("A", "N"): -1, ("A", "R"): -4, ("N", "A"): -2, ("N", "N"): 1, ("N", "R"): 0,
        ("R", "A"): -6, ("R", "N"): -3, ("R", "R"): 8,
    }
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    guess = F.when(F.col("l_discount") < 0.03, "A").when(F.col("l_discount") < 0.07, "N").otherwise("R")
    counts = lines.groupBy(F.col("l_returnflag").alias("y_true"), guess.alias("y_pred")).agg(F.count("*").alias("n"))
    return rounded(metrics.cost_benefit(counts, values))


@query(
    "roc_auc",
    f"WITH {SCORES_SQL}, {STEPS_SQL} SELECT model, round(sum(neg*(cum_pos - pos/2.0::DOUBLE)) "
    "/ (first(p_all)::DOUBLE*first(n_all)), 9) AS roc_auc FROM steps GROUP BY model",
)
def roc_auc(spark, sf_dir):
    return rounded(curves.ranking_metrics(line_scores(spark, sf_dir), ["model"]).select("model", "roc_auc"))


@query(
    "average_precision",
    f"WITH {SCORES_SQL}, {STEPS_SQL} SELECT model, round(sum(pos*(cum_pos::DOUBLE/(cum_pos+cum_neg))) "
    "/ first(p_all)::DOUBLE, 9) AS pr_auc FROM steps GROUP BY model",
)
def average_precision(spark, sf_dir):
    return rounded(curves.ranking_metrics(line_scores(spark, sf_dir), ["model"]).select("model", "pr_auc"))


@query(
    "roc_curve",
    f"""WITH {SCORES_SQL}, {STEPS_SQL}
    SELECT model, score AS threshold, round(cum_neg::DOUBLE/n_all, 9) AS fpr, round(cum_pos::DOUBLE/p_all, 9) AS tpr
    FROM steps WHERE (cum_pos = pos AND cum_neg = neg) OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
    UNION ALL SELECT DISTINCT model, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM steps""",
)
def roc_curve(spark, sf_dir):
    return rounded(curves.roc_curve(line_scores(spark, sf_dir), ["model"]), 9, ("threshold",))


@query(
    "pr_curve",
    f"""WITH {SCORES_SQL}, {STEPS_SQL}
    SELECT model, score AS threshold, round(cum_pos::DOUBLE/(cum_pos+cum_neg), 9) AS precision,
           round(cum_pos::DOUBLE/p_all, 9) AS recall FROM steps
    UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM steps""",
)
def pr_curve(spark, sf_dir):
    return rounded(curves.pr_curve(line_scores(spark, sf_dir), ["model"]), 9, ("threshold",))


@query(
    "roc_area",
    f"WITH {SCORES_SQL}, {STEPS_SQL} SELECT model, round(sum(neg::DOUBLE/n_all*(cum_pos - pos/2.0::DOUBLE)/p_all), 9) AS area "
    "FROM steps GROUP BY model",
)
def roc_area(spark, sf_dir):
    return rounded(curves.roc_area(line_scores(spark, sf_dir), ["model"]))


@query(
    "log_loss_brier",
    f"""WITH {SCORES_SQL}, c AS (SELECT model, y, p, least(greatest(p, 2.220446049250313e-16::DOUBLE),
            1.0::DOUBLE - 2.220446049250313e-16::DOUBLE) AS q FROM scores)
    SELECT model, count(*) AS n, round(avg(CASE WHEN y = 1 THEN -ln(q) ELSE -ln(1.0::DOUBLE - q) END), 8) AS log_loss,
           round(avg((p-y)*(p-y)), 8) AS brier FROM c GROUP BY model""",
)
def log_loss_brier(spark, sf_dir):
    return rounded(metrics.probability_metrics(line_scores(spark, sf_dir), ["model"]), 8)


@query(
    "calibration",
    f"""WITH {SCORES_SQL}, c AS (SELECT model, CAST(greatest(ceil(p*10)-1, 0) AS INTEGER) AS bin, count(*) AS n,
       avg(p) AS mean_p, avg(y::DOUBLE) AS observed FROM scores GROUP BY 1, 2)
    SELECT model, bin, n, round(mean_p, 8) AS mean_p, round(observed, 8) AS observed,
       CASE WHEN observed < mean_p THEN 'over-confident' WHEN observed > mean_p THEN 'under-confident'
            ELSE 'calibrated' END AS verdict FROM c""",
)
def calibration(spark, sf_dir):
    return rounded(metrics.calibration_curve(line_scores(spark, sf_dir), by=["model"]), 8)


@query(
    "class_report",
    f"""WITH {SCORES_SQL}, c AS (SELECT y AS t, label AS f, count(*) AS n FROM scores GROUP BY ALL),
    k AS (SELECT v, sum(n) FILTER (WHERE t = v) AS support, sum(n) FILTER (WHERE f = v) AS predicted,
                 sum(n) FILTER (WHERE t = v AND f = v) AS hit FROM c, (VALUES (0),(1)) l(v) GROUP BY v),
    r AS (SELECT v, support::DOUBLE AS support, hit::DOUBLE AS hit, hit::DOUBLE/predicted AS precision, hit::DOUBLE/support AS recall,
                 2.0*hit::DOUBLE/(predicted+support) AS f1 FROM k)
    SELECT CASE v WHEN 0 THEN 'kept' ELSE 'returned' END AS label, round(precision, 9) AS precision, round(recall, 9) AS recall,
           round(f1, 9) AS f1, support FROM r
    UNION ALL SELECT 'accuracy', round(sum(hit)/sum(support), 9), round(sum(hit)/sum(support), 9),
                     round(sum(hit)/sum(support), 9), round(sum(hit)/sum(support), 9) FROM r
    UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), sum(support) FROM r
    UNION ALL SELECT 'weighted avg', round(sum(precision*support)/sum(support), 9), round(sum(recall*support)/sum(support), 9),
                     round(sum(f1*support)/sum(support), 9), sum(support) FROM r""",
)
def class_report(spark, sf_dir):
    matrix = metrics.confusion_matrix(line_scores(spark, sf_dir))
    return rounded(metrics.classification_report(matrix, {0: "kept", 1: "returned"}))


SWEEP_SQL = (
    f"{SCORES_SQL}, {SWEEP_CELLS_SQL.format(last=100)}, sweep AS ({metrics_sql('cells', 'model, threshold')})"
)


@query("threshold_sweep", f"WITH {SWEEP_SQL} SELECT * FROM sweep")
def threshold_sweep(spark, sf_dir):
    return rounded(threshold.threshold_sweep(line_scores(spark, sf_dir), by=["model"]), 9, ("threshold",))


@query(
    "threshold_sweep_100",
    f"WITH {SCORES_SQL}, {SWEEP_CELLS_SQL.format(last=99)} {metrics_sql('cells', 'model, threshold')}",
)
def threshold_sweep_100(spark, sf_dir):
    sweep = threshold.threshold_sweep(line_scores(spark, sf_dir), 100, ["model"])
    return rounded(sweep, 9, ("threshold",))


BEST_SQL = (
    f"{SWEEP_SQL}, long AS ({TUNABLE_SQL}), best AS (SELECT model, metric, threshold, value FROM (SELECT *, row_number() OVER "
    "(PARTITION BY model, metric ORDER BY value DESC, threshold) AS rn FROM long) WHERE rn = 1)"
)


@query("best_threshold", f"WITH {BEST_SQL} SELECT * FROM best")
def best_threshold(spark, sf_dir):
    sweep = rounded(threshold.threshold_sweep(line_scores(spark, sf_dir), by=["model"], only=threshold.TUNABLE), 9, ("threshold",))
    return threshold.best_threshold(sweep, ["model"])


@query(
    "threshold_compare",
    f"""WITH {BEST_SQL}, cut AS (SELECT model, threshold FROM best WHERE metric = 'mcc'),
    a AS (SELECT * FROM sweep WHERE threshold = 0.5),
    b AS (SELECT sweep.* FROM sweep JOIN cut USING (model, threshold))
    """
    + " UNION ALL ".join(
        f"SELECT a.model, cut.threshold, '{m}' AS metric, a.{m} AS at_default, b.{m} AS at_best, "
        f"round(b.{m} - a.{m}, 9) AS difference FROM a JOIN b USING (model) JOIN cut USING (model)"
        for m in metrics.LABEL_METRICS
    ),
)
def threshold_compare(spark, sf_dir):
    scores = line_scores(spark, sf_dir)
    sweep = rounded(threshold.threshold_sweep(scores, by=["model"], only=threshold.TUNABLE), 9, ("threshold",))
    table = threshold.threshold_compare(scores, threshold.best_threshold(sweep, ["model"]), ["model"])
    table = rounded(table, 9, ("threshold", "difference"))
    return table.withColumn("difference", F.round(F.col("at_best") - F.col("at_default"), 9) + 0.0)


@query(
    "thresholded_labels",
    f"""WITH {SCORES_SQL} SELECT model, CASE WHEN p >= 0.3 THEN 1 ELSE 0 END AS label, count(*) AS n, sum(y)::BIGINT AS positives
        FROM scores GROUP BY 1, 2""",
)
def thresholded_labels(spark, sf_dir):
    labelled = threshold.ThresholdLabel(threshold=0.3).transform(line_scores(spark, sf_dir))
    return labelled.groupBy("model", "label").agg(F.count("*").alias("n"), F.sum("y").alias("positives"))


@query(
    "avg_rank",
    f"""WITH {SCORES_SQL}, r AS (SELECT model, key, p, rank() OVER (PARTITION BY model ORDER BY p) AS lo,
          count(*) OVER (PARTITION BY model, p) AS c FROM scores),
        a AS (SELECT model, key, lo + (c - 1)/2.0::DOUBLE AS ar FROM r)
        SELECT model, key, round(ar / max(ar) OVER (PARTITION BY model), 9) AS scaled FROM a""",
)
def avg_rank(spark, sf_dir):
    ranked = clean.rank_scaled(line_scores(spark, sf_dir), "p", "scaled", ["model"])
    return rounded(ranked.select("model", "key", "scaled"))


@query(
    "soft_vote",
    f"""WITH {SCORES_SQL}, v AS (SELECT key, avg(p) AS p FROM scores GROUP BY key)
        SELECT key, round(p, 9) AS p, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS label FROM v""",
)
def soft_vote(spark, sf_dir):
    from tallyfold.plans.ensemble import soft_vote as vote

    return rounded(vote(line_scores(spark, sf_dir), ["key"]).select("key", "p", "label"))


OVERFIT_SQL = f"{SCORES_SQL}, acc AS (SELECT model, fold, avg((y = label)::INT::DOUBLE) AS val_acc FROM scores GROUP BY ALL)"


@query(
    "overfit_summary",
    f"WITH {OVERFIT_SQL}, both_acc AS (SELECT model, fold, val_acc, 1.0 - (1.0 - val_acc)/2 AS train_acc FROM acc), "
    "m AS (SELECT model, median(train_acc) AS train_acc, median(val_acc) AS val_acc FROM both_acc GROUP BY model) "
    "SELECT model, round(train_acc, 8) AS train_acc, round(val_acc, 8) AS val_acc, round(train_acc - val_acc, 8) AS gap FROM m",
)
def overfit_summary(spark, sf_dir):
    folds = metrics.binary_metrics(line_scores(spark, sf_dir), ["model", "fold"], only=("accuracy",))
    cv = folds.select("model", "fold", F.col("accuracy").alias("val_acc"), (1 - (1 - F.col("accuracy")) / 2).alias("train_acc"))
    return rounded(diagnose.overfit_summary(cv), 8)


@query(
    "score_summary",
    f"WITH {OVERFIT_SQL}, s AS (SELECT model, quantile_cont(val_acc, 0.25) AS q1, quantile_cont(val_acc, 0.5) AS median, "
    "quantile_cont(val_acc, 0.75) AS q3 FROM acc GROUP BY model) SELECT model, round(q1, 8) AS q1, round(median, 8) AS median, "
    "round(q3, 8) AS q3, round(max(median) OVER (), 8) AS best_median FROM s",
)
def score_summary(spark, sf_dir):
    from tallyfold.operators.profile import score_summary as summary

    folds = metrics.binary_metrics(line_scores(spark, sf_dir), ["model", "fold"], only=("accuracy",))
    return rounded(summary(folds, "model", "accuracy"), 8)
