"""Trained-model queries over the labelled documents, and one over the census-like frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.rounding import rounded
from tallyfold.operators import clean, diagnose, split
from tallyfold.operators.curves import ranking_metrics
from tallyfold.operators.features import feature_names
from tallyfold.operators.metrics import binary_metrics
from tallyfold.operators.resample import STRATEGIES
from tallyfold.operators.threshold import best_threshold, chosen_threshold, threshold_sweep
from tallyfold.plans import ensemble, evaluate, linear
from tallyfold.plans.evaluate import Candidate, TableSpec
from tallyfold.plans.foldset import holdout_set
from tallyfold.plans.models import importance_table
from tallyfold.plans.registry import query
from tallyfold.plans.split_queries import SPLIT_SQL, folds_sql
from tallyfold.runtime import lookup_join, stage
from tallyfold.sources.tables import CENSUS_SQL, QUALITY_CATS, QUALITY_NUMS, census, metrics_sql, quality

QUALITY = TableSpec("doc_id", QUALITY_NUMS, QUALITY_CATS)
# Short settings: the same learners with fewer trees.
LOGISTIC = Candidate("LogisticRegression", {"max_iter": 100})
FOREST = Candidate("RandomForest", {"n_estimators": 20, "max_depth": 8})
BOOSTED = Candidate("GradientBoosting", {"n_estimators": 10})
LEAFWISE = Candidate("LightGBM", {"n_estimators": 10})
KERNEL = Candidate("SVC", {"max_iter": 50})
NETWORK = Candidate("MLPClassifier", {"hidden_layer_sizes": "16", "max_iter": 50})
DUMMY = Candidate("DummyMostFreq")


def quality_halves(spark, sf_dir):
    rows = stage(split.stratified_split(quality(spark, sf_dir), ["doc_id"], "y"), "quality")
    return rows.where("split = 'train'"), rows.where("split = 'test'")


def test_scores(spark, sf_dir, c: Candidate):
    train, test = quality_halves(spark, sf_dir)
    return ensemble.base_scores(train, test, QUALITY, [c]).select("key", "y", "p", "label")


# Which rows are scored, and their class, is determined; scores are not. The queries say of every test row whether its score is
# a probability and its label the one that the score stands for, and of the model whether it has learned: more training rows are
# right than the larger class has, or, for a logistic regression, the gradient of its objective vanishes.
QUALITY_CENSUS = "census AS (SELECT doc_id AS id, quality AS y FROM labels JOIN documents USING (doc_id))"
QUALITY_SPLIT_SQL = SPLIT_SQL.replace(CENSUS_SQL, QUALITY_CENSUS)
SCORED_SQL = f"WITH {QUALITY_SPLIT_SQL} SELECT id AS key, y, TRUE AS p_ok, TRUE AS label_ok FROM halves WHERE split = 'test'"
LEARNED_SQL = SCORED_SQL.replace("AS label_ok", "AS label_ok, TRUE AS learned")


def checked(scores, *flags):
    """(key, y, p_ok, label_ok); label 1 stands for p > 0.5."""
    label_ok = F.col("label") == (F.col("p") > 0.5).cast("int")
    return scores.select(
        F.col("key").cast("long").alias("key"), "y", F.col("p").between(0, 1).alias("p_ok"), label_ok.alias("label_ok"), *flags
    )


def checked_ranks(scores, *flags):
    """The same for scores that are ranks of a margin: every row of label 1 ranks above every row of label 0."""
    top_of_0 = scores.where("label = 0").agg(F.max("p")).first()[0]
    label_ok = (F.col("label") == 0) | (F.col("p") > (top_of_0 or 0.0))
    return scores.select(
        F.col("key").cast("long").alias("key"), "y", F.col("p").between(0, 1).alias("p_ok"), label_ok.alias("label_ok"), *flags
    )


def beats_majority(scores) -> bool:
    """Whether more rows are labelled right than the larger class has."""
    row = scores.agg(F.avg((F.col("y") == F.col("label")).cast("double")).alias("hit"), F.avg("y").alias("share")).first()
    return row["hit"] > max(row["share"], 1 - row["share"])


def _scores(c: Candidate, check=checked, least_rows: int = 0):
    """``least_rows``: a learner that may not cut so few training rows into leaves is not asked what it has learned."""

    def run(spark, sf_dir):
        train, test = quality_halves(spark, sf_dir)
        scores = evaluate.score_candidates(holdout_set(train, test, QUALITY), [c], ("train", "valid"))
        trained = scores.where("part = 'train'")
        learned = beats_majority(trained) or trained.count() < least_rows
        return check(scores.where("part = 'valid'"), F.lit(learned).alias("learned"))

    return run


def at_optimum(folds, models, scores):
    """(model, repeat, fold, optimal): the gradient, summed up anew from the scores of the training rows, vanishes."""
    table = linear.gradient_table(folds, models, scores)
    flat = F.max(F.abs("gradient") / F.greatest("terms", F.lit(1e-300)))
    return table.groupBy("model", "repeat", "fold").agg((flat < 1e-6).alias("optimal"))


@query("lr_scores", LEARNED_SQL)
def lr_scores(spark, sf_dir):
    train, test = quality_halves(spark, sf_dir)
    folds = holdout_set(train, test, QUALITY)
    models = linear.fit_linear(folds, [LOGISTIC])
    scores = stage(linear.score_linear(folds, models, ("train", "valid")), "scores")
    optimal = at_optimum(folds, models, scores).first()["optimal"]
    return checked(scores.where("part = 'valid'"), F.lit(optimal).alias("learned"))


query("rf_scores", LEARNED_SQL)(_scores(FOREST))
query("gbt_scores", LEARNED_SQL)(_scores(BOOSTED))
# Leaves hold at least 20 rows.
query("gbt_lgbm_like_scores", LEARNED_SQL)(_scores(LEAFWISE, least_rows=200))
query("svc_like_scores", LEARNED_SQL)(_scores(KERNEL, checked_ranks))
query("mlp_scores", LEARNED_SQL)(_scores(NETWORK))

# Candidates of the optimum query: penalties from strong to weak, with and without class weights.
REGRESSIONS = [
    Candidate("LogisticRegression", {"C": c, "class_weight": w}, "none", f"C={c:g} {w or 'plain'}")
    for c in (0.01, 1.0, 15.0) for w in (None, "balanced")
]


@query(
    "lr_optimum",
    f"""WITH {QUALITY_CENSUS}, {folds_sql(3, 2)},
    m AS (SELECT unnest({[c.name for c in REGRESSIONS]}) AS model)
    SELECT model, f.repeat, g.fold::INTEGER AS fold, count(*) FILTER (WHERE f.fold <> g.fold) AS n_train,
           count(*) FILTER (WHERE f.fold = g.fold) AS n_valid, TRUE AS optimal
    FROM folds f, range(1, 4) g(fold), m GROUP BY ALL""",
)
def lr_optimum(spark, sf_dir):
    """Regressions of six settings on 3 x 2 folds, fitted and scored together: rows scored per fold, and the gradient's size."""
    folds = evaluate.fold_frames(quality(spark, sf_dir), QUALITY, 3, 2)
    models = linear.fit_linear(folds, REGRESSIONS)
    scores = stage(linear.score_linear(folds, models, ("train", "valid")), "scores")
    counts = scores.groupBy("model", "repeat", "fold").agg(
        F.count(F.when(F.col("part") == "train", 1)).alias("n_train"), F.count(F.when(F.col("part") == "valid", 1)).alias("n_valid")
    )
    return lookup_join(counts, at_optimum(folds, models, scores), ["model", "repeat", "fold"], "inner")


@query(
    "out_of_fold",
    f"""WITH {QUALITY_CENSUS}, {folds_sql(3, 2)},
    m AS (SELECT unnest(['DummyMostFreq', 'LogisticRegression', 'RandomForest']) AS model)
    SELECT model, id AS key, y, f.repeat, f.fold, TRUE AS p_ok FROM folds f, m""",
)
def out_of_fold(spark, sf_dir):
    """Every row is scored once per model and repeat, by the fold that leaves it out."""
    folds = evaluate.fold_frames(quality(spark, sf_dir), QUALITY, 3, 2)
    scores = evaluate.score_candidates(folds, [DUMMY, LOGISTIC, FOREST])
    return scores.select("model", F.col("key").cast("long").alias("key"), "y", "repeat", "fold", F.col("p").between(0, 1).alias("p_ok"))


@query(
    "cv_baseline",
    f"""WITH {QUALITY_CENSUS}, {folds_sql(3, 2)},
    top AS (
      SELECT f.repeat, g.fold::INTEGER AS fold, (count(*) FILTER (WHERE y = 1) > count(*) FILTER (WHERE y = 0))::INTEGER AS label
      FROM folds f JOIN range(1, 4) g(fold) ON f.fold <> g.fold GROUP BY ALL),
    cells AS (
      SELECT repeat, fold, count(*) FILTER (WHERE y = 1 AND label = 1) AS tp, count(*) FILTER (WHERE y = 0 AND label = 1) AS fp,
             count(*) FILTER (WHERE y = 0 AND label = 0) AS tn, count(*) FILTER (WHERE y = 1 AND label = 0) AS fn
      FROM folds JOIN top USING (repeat, fold) GROUP BY ALL)
    SELECT 'DummyMostFreq' AS model, 3 AS n_splits, 2 AS n_repeats_cv, 'none' AS sampling_strategy, 0.5::DOUBLE AS roc_auc,
           round((tp + fn)::DOUBLE / (tp + fp + tn + fn), 9) AS pr_auc, * EXCLUDE (tp, fp, tn, fn)
    FROM ({metrics_sql("cells", "repeat, fold")})""",
)
def cv_baseline(spark, sf_dir):
    """All metrics of the majority baseline over 3 x 2 folds."""
    return rounded(evaluate.cv_results(quality(spark, sf_dir), QUALITY, [DUMMY], 3, 2))


@query("quality_test_metrics")
def quality_test_metrics(spark, sf_dir):
    """Split, encode, fit a balanced logistic regression, one row of test metrics."""
    scores = test_scores(spark, sf_dir, LOGISTIC).withColumn("model", F.lit(LOGISTIC.name))
    table = binary_metrics(scores, ["model"]).join(ranking_metrics(scores, ["model"]), "model")
    return rounded(table)


@query("census_lr_metrics")
def census_lr_metrics(spark, sf_dir):
    """The same chain at table size, on a target that carries no signal."""
    frame = clean.encode_binary(clean.sentinel_to_null(census(spark, sf_dir)), "income").drop("income")
    rows = stage(split.stratified_split(frame, ["id"], "y"), "census")
    spec = TableSpec("id", ("total", "balance", "gain"), ("status", "segment"), scaler="routed")
    scores = ensemble.base_scores(rows.where("split = 'train'"), rows.where("split = 'test'"), spec, [LOGISTIC])
    return rounded(binary_metrics(scores, ["model"]))


@query("cv_accuracy")
def cv_accuracy(spark, sf_dir):
    return rounded(evaluate.cross_validate(quality(spark, sf_dir), QUALITY, [DUMMY, LOGISTIC], 3))


@query("cv_results")
def cv_results(spark, sf_dir):
    return rounded(evaluate.cv_results(quality(spark, sf_dir), QUALITY, [DUMMY, LOGISTIC, FOREST], 3))


@query("cv_resampled")
def cv_resampled(spark, sf_dir):
    """Every sampling strategy in front of the same learner, training rows only."""
    tried = [Candidate("LogisticRegression", {"max_iter": 50, "class_weight": None}, s, s) for s in STRATEGIES]
    return rounded(evaluate.cv_results(quality(spark, sf_dir), QUALITY, tried, 2))


@query("trials")
def trials(spark, sf_dir):
    tried = [evaluate.suggest("LogisticRegression", i, ("none", "random_undersample", "random_oversample")) for i in range(4)]
    short = [Candidate(c.model, {**c.params, "max_iter": 50}, c.sampling, c.label) for c in tried]
    return rounded(evaluate.tuning_study(quality(spark, sf_dir), QUALITY, short, "mcc", 2))


@query("grid_best_params")
def grid_best_params(spark, sf_dir):
    tried = evaluate.grid("LogisticRegression", {"C": [0.1, 15.0], "max_iter": [50]})
    study = evaluate.tuning_study(quality(spark, sf_dir), QUALITY, tried, "balanced_accuracy", 2)
    return rounded(evaluate.best_params(study))


@query("select_refit")
def select_refit(spark, sf_dir):
    """Compare by cross-validation, refit the best on all training rows, score the test rows."""
    train, test = quality_halves(spark, sf_dir)
    tried = [DUMMY, LOGISTIC]
    folds = evaluate.cv_results(train, QUALITY, tried, 2)
    comparison = diagnose.model_comparison(folds, ["mcc"], "mcc")
    chosen, fitted, model = evaluate.select_and_refit(train, QUALITY, comparison, tried, "mcc")
    scores = evaluate.score_table(fitted, model, test, QUALITY)
    return rounded(binary_metrics(scores).withColumn("model", F.lit(chosen.name)))


@query("soft_vote_scores", LEARNED_SQL.replace("AS learned", "AS learned, TRUE AS mean_ok"))
def soft_vote_scores(spark, sf_dir):
    """The vote of two models; ``mean_ok`` says that it is the mean of what they say."""
    train, test = quality_halves(spark, sf_dir)
    bases = [LOGISTIC, FOREST]
    scores = evaluate.score_candidates(holdout_set(train, test, QUALITY), bases, ("train", "valid"))
    votes = stage(ensemble.soft_vote(scores, ["key", "part"]), "votes")
    one, other = (scores.where(F.col("model") == c.name).select("key", F.col("p").alias(f"p{i}")) for i, c in enumerate(bases))
    tested = votes.where("part = 'valid'").join(one, "key").join(other, "key")
    mean_ok = F.abs(F.col("p") - (F.col("p0") + F.col("p1")) / 2) < 1e-12
    return checked(tested, F.lit(beats_majority(votes.where("part = 'train'"))).alias("learned"), mean_ok.alias("mean_ok"))


@query("stacking", LEARNED_SQL)
def stacking(spark, sf_dir):
    train, test = quality_halves(spark, sf_dir)
    tested, learned = ensemble.stacking(train, test, QUALITY, [LOGISTIC, FOREST], 3, meta=BOOSTED)
    return checked(tested, F.lit(beats_majority(learned)).alias("learned"))


@query("ensemble_decision")
def ensemble_decision(spark, sf_dir):
    """Soft vote against its best member on the test rows.

    The member and every threshold are chosen on out-of-fold scores of the training rows.
    """
    train, test = quality_halves(spark, sf_dir)
    bases = [LOGISTIC, FOREST]

    def with_vote(scores):
        scores = scores.select("model", "key", "y", "p")
        vote = ensemble.soft_vote(scores, ["key"]).withColumn("model", F.lit("soft vote"))
        return stage(scores.unionByName(vote.select("model", "key", "y", "p")))

    held_out = with_vote(evaluate.score_candidates(evaluate.fold_frames(train, QUALITY, 2, 1), bases))
    best = stage(best_threshold(threshold_sweep(held_out, by=["model"], only=("mcc",)), ["model"], ("mcc",)))
    scored = with_vote(ensemble.base_scores(train, test, QUALITY, bases))
    cut = lookup_join(scored, best.select("model", F.col("threshold").alias("cut")), ["model"], "inner")
    tested = binary_metrics(cut.withColumn("label", (F.col("p") >= F.col("cut")).cast("int")), ["model"]).select("model", "mcc")
    member = clean.top_k(best.where("model <> 'soft vote'"), "value", 1, "model").select("model")
    single = tested.join(member, "model")
    return rounded(diagnose.ensemble_decision(single, tested.where("model = 'soft vote'")))


@query("learning_curve")
def learning_curve(spark, sf_dir):
    points = evaluate.learning_curve(quality(spark, sf_dir), QUALITY, LOGISTIC, split.training_sizes(0.3, 1.0, 3), 2)
    return rounded(diagnose.learning_summary(points, ["size"]))


@query("feature_importance")
def feature_importance(spark, sf_dir):
    frame = quality(spark, sf_dir)
    encoded, fitted = evaluate.encode(frame, frame, QUALITY)
    model = evaluate.fit_candidate(encoded, FOREST)
    return rounded(importance_table(model, feature_names(fitted, list(QUALITY_NUMS), list(QUALITY_CATS)), spark))


@query("tuned_threshold_metrics")
def tuned_threshold_metrics(spark, sf_dir):
    """Threshold chosen on out-of-fold training scores, applied to the test rows."""
    train, test = quality_halves(spark, sf_dir)
    held_out = evaluate.score_candidates(evaluate.fold_frames(train, QUALITY, 2, 1), [LOGISTIC])
    cut = chosen_threshold(best_threshold(threshold_sweep(held_out)), "auto", "mcc")
    scores = ensemble.base_scores(train, test, QUALITY, [LOGISTIC])
    labelled = scores.withColumn("label", (F.col("p") >= cut).cast("int"))
    return rounded(binary_metrics(labelled).withColumn("threshold", F.lit(cut)))
