"""Labelling, file sources and sinks, and the streaming form."""

import io
import json
import zipfile

import pandas as pd
import pytest
from pyspark.sql import types as T

from tallyfold.operators import text
from tallyfold.sources import files
from tallyfold.streaming.labelling import file_stream, start_labelling

REVIEWS = [
    {"id": 1, "text": "I love it, best purchase"},
    {"id": 2, "text": "Terrible and rude, a waste"},
    {"id": 3, "text": "It arrived on Tuesday"},
    {"id": 4, "text": ""},
]


def test_label_normaliser(spark):
    raw = ["Positive.", "neg", "NEUTRAL!", "", "maybe", None, " \n postponed", "it is positive", "NEGPOS"]
    want = ["POSITIVE", "NEGATIVE", "NEUTRAL", "UNKNOWN", "UNKNOWN", "UNKNOWN", "POSITIVE", "UNKNOWN", "POSITIVE"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "id int, raw string")
    assert [r["label"] for r in df.select("id", text.normalise_label("raw").alias("label")).orderBy("id").collect()] == want


def test_classify_keeps_columns_and_tally_order(spark):
    df = files.inline_rows(spark, REVIEWS, "id bigint, text string")
    out = text.classify(df, text.lexicon_scorer(text.REVIEW_WORDS))
    assert out.columns == ["id", "text", "raw", "label"]
    assert [r["label"] for r in out.orderBy("id").collect()] == ["POSITIVE", "NEGATIVE", "NEUTRAL", "NEUTRAL"]
    assert [tuple(r) for r in text.label_tally(out).collect()] == [("POSITIVE", 1), ("NEGATIVE", 1), ("NEUTRAL", 2)]
    assert text.run_statistics(out)["rows"] == 4


def test_prompt_variants(spark):
    df = files.inline_rows(spark, REVIEWS[:1], "id bigint, text string")
    names = ("VERY POSITIVE", "POSITIVE", "NEUTRAL")
    messages = df.select(text.prompt_messages("text", names, (("Great!", "POSITIVE"),)).alias("m")).first()["m"]
    assert [m["role"] for m in messages] == ["system", "user"]
    assert "VERY POSITIVE, POSITIVE, or NEUTRAL" in messages[0]["content"] and "Great!" in messages[0]["content"]


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("work", T.StringType()), T.StructField("x", T.DoubleType())])


def test_zipped_csv(spark, tmp_path):
    for i in range(3):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            z.writestr("a.csv", pd.DataFrame({"id": [i, i + 10], "work": ["?", "a,b"], "x": [1.5, None]}).to_csv(index=False))
        (tmp_path / f"{i}.zip").write_bytes(buffer.getvalue())
    rows = files.read_zipped_csv(spark, f"{tmp_path}/*.zip", SCHEMA).orderBy("id").collect()
    assert [tuple(r) for r in rows[:1]] == [(0, None, 1.5)] and tuple(rows[-1]) == (12, "a,b", None)
    with pytest.raises(ValueError):
        files.read_csv(spark, f"{tmp_path}/0.zip", SCHEMA)


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "?", 0.5), (2, "b", None)], SCHEMA)
    files.write_csv(df, str(tmp_path / "out"), row_label="work")
    back = files.read_csv(spark, str(tmp_path / "out"))
    assert back.columns == ["work", "id", "x"] and back.where("work is null").count() == 1


def test_json_array_file(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps(REVIEWS, indent=1))
    df = files.read_json_array(spark, str(tmp_path / "r.json"), "id bigint, text string")
    assert df.count() == 4 and df.where("text = ''").count() == 1


def test_labelling_a_stream_equals_the_batch(spark, tmp_path):
    df = files.inline_rows(spark, REVIEWS, "id bigint, text string")
    df.repartition(3).write.parquet(str(tmp_path / "in"))

    def label(frame):
        return text.classify(frame, text.lexicon_scorer(text.REVIEW_WORDS))

    stream = file_stream(spark, str(tmp_path / "in"), df.schema)
    start_labelling(stream, label, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination(60)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(label(df).collect())
