"""Bulk text labelling: prompts, pluggable scorers, label normalisation and tallies."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.scalars import first_token_upper, preview
from tallyfold.runtime import lookup_join

LABELS = ("POSITIVE", "NEGATIVE", "NEUTRAL", "UNKNOWN")
# The wording of the classification prompt, {names} and {text} filled in.
SYSTEM_PROMPT = "You are a sentiment classifier. You reply with exactly one word: {names}. No explanation."
USER_PROMPT = 'Classify this review:\n"{text}"'
# Word weights of the built-in review lexicon.
REVIEW_WORDS = {
    "amazing": 1.0, "best": 1.0, "delicious": 1.0, "excellent": 1.0, "exceeded": 1.0, "fast": 1.0, "great": 1.0,
    "love": 1.0, "loved": 1.0, "perfect": 1.0, "recommended": 1.0, "wonderful": 1.0,
    "bad": -1.0, "bland": -1.0, "broke": -1.0, "cold": -1.0, "misleading": -1.0, "rude": -1.0, "slow": -1.0,
    "terrible": -1.0, "unhelpful": -1.0, "waste": -1.0, "worst": -1.0,
}


def prompt_messages(
    text: str | Column = "text", names: tuple[str, ...] = LABELS[:3], examples: tuple[tuple[str, str], ...] = ()
) -> Column:
    """``array<struct<role, content>>``: a system message with the label names, then the text."""
    listed = ", ".join(names[:-1]) + f", or {names[-1]}"
    system = SYSTEM_PROMPT.format(names=listed)
    system += "".join(f' Example: "{t}" -> {label}' for t, label in examples)
    before, after = USER_PROMPT.split("{text}")
    text = F.col(text) if isinstance(text, str) else text

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    user = F.concat(F.lit(before), F.coalesce(text, F.lit("")), F.lit(after))
    return F.array(message("system", F.lit(system)), message("user", user))


def normalise_label(raw: str | Column = "raw") -> Column:
    """Label from the upper-cased first word: POS, then NEG, then NEU anywhere inside it, else UNKNOWN."""
    word = first_token_upper(raw)
    return (
        F.when(word.contains("POS"), "POSITIVE").when(word.contains("NEG"), "NEGATIVE")
        .when(word.contains("NEU"), "NEUTRAL").otherwise("UNKNOWN")
    )


def classify(df: DataFrame, load_scorer: Callable[[], Callable[[pd.Series], pd.Series]], text: str = "text") -> DataFrame:
    """Add ``raw`` (the scorer's answer) and ``label``; input columns pass through.

    ``load_scorer`` runs once per Python task, before its first batch; the scorer it returns gets
    whole texts as Arrow batches.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("raw", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = None
        for pdf in batches:
            scorer = scorer or load_scorer()
            yield pdf.assign(raw=list(scorer(pdf[text])))

    return df.mapInPandas(run, schema).withColumn("label", normalise_label("raw"))


def score_to_answer(score: Column, margin: float = 0.0) -> Column:
    return F.when(score > margin, "positive").when(score < -margin, "negative").otherwise("neutral")


def lexicon_scorer(words: dict[str, float], margin: float = 0.0) -> Callable[[], Callable[[pd.Series], pd.Series]]:
    """A scorer for :func:`classify` that sums word weights."""

    def load():
        def answer(text: str | None) -> str:
            score = sum(words.get(t, 0.0) for t in (text or "").lower().split(" "))
            return "positive" if score > margin else "negative" if score < -margin else "neutral"

        return lambda texts: texts.map(answer)

    return load


def lexicon_label(
    df: DataFrame, key: str, lexicon: DataFrame, text: str = "text", margin: float = 0.0
) -> DataFrame:
    """(key, score, raw, label) from word weights, all in SQL operators.

    Tokens are summed per document before the shuffle, so one row per document is exchanged and
    texts never are. Texts without a known word stay in with score 0.
    """
    tokens = df.select(key, F.explode_outer(F.split(F.lower(text), " ", -1)).alias("word"))
    scored = lookup_join(tokens, lexicon.select("word", "weight"), ["word"], "left")
    sums = scored.groupBy(key).agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("score"))
    raw = score_to_answer(F.col("score"), margin)
    return sums.select(key, "score", raw.alias("raw"), normalise_label(raw).alias("label"))


def text_features(buckets: int = 1 << 12) -> Pipeline:
    """Tokens, hashed counts and inverse document frequencies as ``features``."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="__tokens", pattern=r"\s+"),
            HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=buckets),
            IDF(inputCol="__tf", outputCol="features"),
        ]
    )


def label_tally(labelled: DataFrame, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """(label, n) in the fixed label order; labels without rows are left out."""
    place = F.array_position(F.lit(list(labels)), F.col("label"))
    return labelled.groupBy("label").agg(F.count("*").alias("n")).orderBy(place)


def unclassified(labelled: DataFrame, key: str) -> DataFrame:
    return labelled.where("label = 'UNKNOWN'").select(key, "raw")


def run_statistics(labelled: DataFrame) -> dict[str, float]:
    """Rows, elapsed seconds and seconds per row of evaluating a labelled frame."""
    start = time.perf_counter()
    rows = labelled.agg(F.count("label")).first()[0]
    elapsed = time.perf_counter() - start
    return {"rows": rows, "elapsed": elapsed, "seconds_per_row": elapsed / rows if rows else 0.0}


def listing(labelled: DataFrame, key: str, text: str = "text") -> DataFrame:
    return labelled.select(key, "label", "raw", preview(text).alias("preview"))
