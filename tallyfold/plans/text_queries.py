"""Bulk labelling of documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.operators import split, text
from tallyfold.plans.model_queries import LEARNED_SQL, beats_majority, checked
from tallyfold.plans.models import fit_model, score_rows
from tallyfold.plans.registry import query
from tallyfold.runtime import stage
from tallyfold.sources.tables import table

# Words that occur in the given texts, with made-up weights.
WORDS = {"the": 1.0, "and": -1.0, "le": 0.5, "la": -0.5, "un": 1.0, "der": 1.0, "die": -1.0, "que": -0.25, "in": -1.0}

PROMPT_SQL = """
SELECT doc_id, 'system' AS role, 'You are a sentiment classifier. You reply with exactly one word: POSITIVE, NEGATIVE, or NEUTRAL. No explanation.' AS content
FROM documents
UNION ALL SELECT doc_id, 'user', 'Classify this review:' || chr(10) || '"' || text || '"' FROM documents
"""
ANSWER_SQL = """
answers AS (SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN 'Positive. ' || text WHEN 1 THEN '  neg ' || text WHEN 2 THEN 'NEUTRAL!'
            WHEN 3 THEN text ELSE '' END AS raw FROM conversations),
words AS (SELECT *, regexp_split_to_array(trim(upper(raw), ' ' || chr(9) || chr(10) || chr(13)), '\\s+')[1] AS w FROM answers),
labelled AS (SELECT conv_id, turn, raw, CASE WHEN contains(w, 'POS') THEN 'POSITIVE' WHEN contains(w, 'NEG') THEN 'NEGATIVE'
             WHEN contains(w, 'NEU') THEN 'NEUTRAL' ELSE 'UNKNOWN' END AS label FROM words)
"""
LEXICON_SQL = (
    "lex(word, weight) AS (VALUES " + ", ".join(f"('{w}', {x}::DOUBLE)" for w, x in WORDS.items()) + "), "
    "tokens AS (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS word FROM documents), "
    "scored AS (SELECT doc_id, coalesce(sum(weight), 0.0) AS score FROM tokens LEFT JOIN lex USING (word) GROUP BY doc_id)"
)
ANSWER_OF_SCORE = "CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative' ELSE 'neutral' END"


def answers(spark, sf_dir):
    """Model-like answers: some clean, some with the text behind them, some empty."""
    raw = (
        F.when(F.col("turn") % 5 == 0, F.concat(F.lit("Positive. "), F.col("text")))
        .when(F.col("turn") % 5 == 1, F.concat(F.lit("  neg "), F.col("text")))
        .when(F.col("turn") % 5 == 2, "NEUTRAL!")
        .when(F.col("turn") % 5 == 3, F.col("text"))
        .otherwise("")
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", raw.alias("raw"))
    return rows.withColumn("label", text.normalise_label("raw"))


@query("prompt_build", PROMPT_SQL)
def prompt_build(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.inline(text.prompt_messages("text")))


@query("label_normalise", f"WITH {ANSWER_SQL} SELECT conv_id, turn, label FROM labelled")
def label_normalise(spark, sf_dir):
    return answers(spark, sf_dir).select("conv_id", "turn", "label")


@query("label_tally", f"WITH {ANSWER_SQL} SELECT label, count(*) AS n FROM labelled GROUP BY label")
def label_tally(spark, sf_dir):
    return text.label_tally(answers(spark, sf_dir))


@query("unclassified", f"WITH {ANSWER_SQL} SELECT conv_id, raw FROM labelled WHERE label = 'UNKNOWN'")
def unclassified(spark, sf_dir):
    return text.unclassified(answers(spark, sf_dir), "conv_id")


@query("lexicon_label", f"WITH {LEXICON_SQL} SELECT doc_id, score, {ANSWER_OF_SCORE} AS raw, upper({ANSWER_OF_SCORE}) AS label FROM scored")
def lexicon_label(spark, sf_dir):
    lexicon = spark.createDataFrame(list(WORDS.items()), "word string, weight double")
    return text.lexicon_label(table(spark, sf_dir, "documents"), "doc_id", lexicon)


@query(
    "batch_classify",
    f"WITH {LEXICON_SQL} SELECT doc_id, {ANSWER_OF_SCORE} AS raw, upper({ANSWER_OF_SCORE}) AS label, substr(text, 1, 45) AS preview "
    "FROM scored JOIN documents USING (doc_id)",
)
def batch_classify(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.listing(text.classify(docs, text.lexicon_scorer(WORDS)), "doc_id")


@query("text_scores", LEARNED_SQL.replace("id AS key", "id AS doc_id"))
def text_scores(spark, sf_dir):
    """A trained scorer: hashed words of the whole text, logistic regression on the quality label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    rows = stage(split.stratified_split(docs.join(labels, "doc_id"), ["doc_id"], "y"), "texts")
    fitted = text.text_features().fit(rows.where("split = 'train'"))
    train = stage(fitted.transform(rows.where("split = 'train'")).select("y", "features"), "text_train")
    model = fit_model("LogisticRegression", train, {"max_iter": 50})
    learned = F.lit(beats_majority(score_rows(model, train))).alias("learned")
    test = fitted.transform(rows.where("split = 'test'")).select("doc_id", "y", "features")
    return checked(score_rows(model, test).withColumn("key", F.col("doc_id")), learned).withColumnRenamed("key", "doc_id")
