"""WARC round trips, benchmark templates, the pipeline, and every query that has SQL."""

import base64
import hashlib

import numpy as np
import pytest
from compare import compare, connect
from pyspark.sql import functions as F
from test_llm_similar import links_of, made_texts, plain_components

import corpus_pipeline
from tallyfold.llm import quality, queries, templates, warc
from tallyfold.llm.parts import read

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, duck, name):
    assert compare(queries.QUERIES[name](spark, SF), duck, queries.SQL[name]) == []


def test_archives_round_trip(spark):
    trap = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nb\r\n\r\n"
    rows = [(1, "http://a/ b\n", trap), (5, None, trap), (3, "u", trap), (2, "u", None), (7, "u", ""), (8, "u", "é" * 100_000), (8, "v", "é" * 100_000), (None, "n", trap), (4, "u", "x")]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, _digest string")
    got = warc.round_trip(pages.repartition(3)).toPandas()
    assert len(got) == len(rows)
    main = got["response"].map(lambda r: r.asDict() if hasattr(r, "asDict") else r)
    seen = sorted((int(p) if p else -1, r["type"], r["refers_to"], r["payload_digest"]) for p, r in zip(got["page"], main))
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    last = {trap: 5, "": 7, None: 7, "é" * 100_000: 8, "x": 4}
    expected = sorted((-1 if i is None else i, "response" if i == last[t] else "revisit", None if i == last[t] else str(last[t]), sha(t)) for i, _, t in rows)
    assert seen == expected
    sizes = dict(zip(got["page"], got["metadata"].map(lambda r: r["payload_bytes"])))
    assert sizes["8"] == 200_000 and sizes["2"] == 0 and sizes["1"] == len(trap)
    assert got["request"].notna().all() and got["capture_id"].is_unique


def test_payloads_come_back_whole(spark):
    pages = spark.createDataFrame([(i, "u", f"<p>{i}\r\n\r\n</p>" * i) for i in range(40)], "page_id long, url string, html string")
    folder = warc.new_stage_path(spark, "warc-test")
    warc.write_archives(pages, folder)
    bodies = {int(r["page"]): r["response"]["body"] for r in warc.assemble(warc.read_records(spark, folder, bodies=True)).collect()}
    assert {i: bytes(b).decode() for i, b in bodies.items()} == {i: f"<p>{i}\r\n\r\n</p>" * i for i in range(40)}
    assert warc.round_trip(pages.limit(0)).count() == 0


ITEM = "While the train to Paris left at 9 hours, my friend Anna paid 40 euros and the friend Anna slept on 2 seats until the city of Rome."


@pytest.mark.parametrize(
    ("text", "changed"),
    [
        (ITEM, 0),
        ("before " + ITEM.lower().replace("9", "9") + " after", None),
        (ITEM.replace("9", "11").replace("Anna", "Bela").replace("euros", "dollars"), 3),
        (ITEM.replace("Anna", "Bela", 1), None),
        ("the train to the city left and my friend paid for the seats", None),
        (" ".join(f"w{i}" for i in range(40)), None),
        (None, None),
        ("", None),
    ],
)
def test_templates_by_case(spark, text, changed):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "too short")], "item_id long, text string")
    docs = spark.createDataFrame([(10, f"Yes, so it was: {text} That is all." if text else text, "w")], "doc_id long, text string, item_id string")
    rows = templates.find_leaks(docs, items).collect()
    if changed is None:
        whole = [r for r in rows if r["n_found"] == r["n_windows"]]
        assert not whole
    else:
        assert [(r["doc_id"], r["item_id"]) for r in rows] == [(10, 1)] and rows[0]["n_changed"] >= changed - 2
        assert (rows[0]["n_changed"] == 0) == (changed == 0)


@pytest.mark.parametrize(
    ("item", "doc"),
    [
        ("12 + 7 = 19, 30 + 5 = 35, 8 + 9 = 17", None),
        ("3 4 5 6", None),
        ("Names: Anna Bela Carla Dora Emma Fritz Gustav Hanna", None),
        ("小明有5个苹果，他又买了3个，现在一共有几个苹果？", None),
        ("小明有5个苹果，他又买了3个，现在一共有几个苹果？", "小明有6个苹果，他又买了4个，现在一共有几个苹果？"),
        ("ประเทศไทยมีกี่จังหวัด", None),
        ("リンゴが好きな人は何人いますか。", None),
        ("Boston has how many people", None),
        ("Boston is very old", None),
        ("Boston is how old if Anna is 5 years", None),
    ],
)
@pytest.mark.parametrize("around", ["so he said {} and then left", "{}", "他说{}然后"])
def test_items_of_every_kind_are_found(spark, item, doc, around):
    if around.startswith("他") and item.isascii():
        around = "他说 {} 然后"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    other = "there were 3 4 cats and Anna sat with 小明 in the city of Boston which is very old"
    docs = spark.createDataFrame([(1, around.format(doc or item)), (2, other), (3, "他又去买了很多苹果和香蕉")], "doc_id long, text string")
    got = templates.find_leaks(docs, items).collect()
    assert [r["doc_id"] for r in got] == [1] and (doc is not None or got[0]["n_found"] == got[0]["n_windows"])


LONG = ("the farmer had 40 sheep on the large green field behind the old house and then the dog chased them all around "
        "the barn until the cook who was very tired at last counted just 3 hens with 5 eggs and again 40 sheep by the gate")  # fmt: skip


@pytest.mark.parametrize(("old", "new"), [("again 40", "again 50"), ("3 hens with 5", "4 hens with 4"), ("40 sheep on", "9 sheep on")])
def test_one_contradiction_does_not_lose_an_alignment(spark, old, new):
    assert old in LONG
    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    docs = spark.createDataFrame([(1, LONG.replace(old, new)), (2, "9 sheep and 4 hens with 4 eggs by the gate")], "doc_id long, text string")
    rows = templates.find_leaks(docs, items).collect()
    assert [r["doc_id"] for r in rows] == [1] and rows[0]["n_found"] >= rows[0]["n_windows"] - 8 and rows[0]["n_changed"] > 0


def test_stretches_end_at_contradictions():
    cut = templates.consistent_windows
    assert cut(None) is None
    assert cut([(0, False, [(1, 1)]), (1, True, [(1, 2)]), (2, False, [(1, 1), (1, 2)]), (5, False, [(3, 4), (5, 4)]), (6, False, [(3, 4)])]) == ([0, 1, 6], [0, 6], 2)


def test_leaks_agree_with_brute_force(spark):
    """Items that stand in a document word by word, and only they, are found; repeated and empty rows do no harm."""
    docs, items = read(spark, SF, "documents"), read(spark, SF, "benchmark")
    got = {(r["doc_id"], r["item_id"]) for r in templates.find_leaks(docs.unionByName(docs.limit(3)), items).collect()}
    flat = lambda t: " ".join(t.split())
    texts, wanted = [(r[0], flat(r[1])) for r in docs.select("doc_id", "text").collect()], [(r[0], flat(r[1])) for r in items.select("item_id", "text").collect()]
    expected = {(d, i) for d, t in texts for i, w in wanted if w in t}
    assert expected <= got and {d for d, _ in got} == {d for d, _ in expected}
    assert templates.find_leaks(docs.limit(0), items).count() == 0 and templates.find_leaks(docs, items.limit(0)).count() == 0


def test_pipeline_stages(spark):
    texts = made_texts()
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "x", "y") for i, t in enumerate(texts)] + [(3, texts[3], "en", "s0", 1, "x", "y")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _key string, _times string")
    one = corpus_pipeline.keep_one_of_each(spark, docs, SF)
    assert one.columns == docs.columns
    sets, pairs = links_of(texts)
    heads = {c for c, s in zip(plain_components(len(texts), pairs), sets) if s} | {i for i, s in enumerate(sets) if not s}
    assert sorted(r[0] for r in one.select("doc_id").collect()) == sorted(heads)

    leaked = docs.limit(5).unionByName(read(spark, SF, "benchmark").select((F.col("item_id") + 5000).alias("doc_id"), "text"), allowMissingColumns=True)
    kept = corpus_pipeline.drop_leaks(spark, leaked, SF)
    assert kept.columns == docs.columns and kept.where("doc_id >= 5000").count() == 0 and kept.count() == 5

    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    words = lambda df: df.select(F.sum(F.size(F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda x: x != "")))).first()[0]
    assert mixed.columns == docs.columns and abs(words(mixed) - words(docs)) < 400
    times = mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert times <= 3 * 3  # three equal rows, three epochs each at most

    placed = corpus_pipeline.shard(spark, mixed, SF).toPandas()
    assert len(placed) == mixed.count() and placed.groupby("shard").size().agg(lambda s: s.max() - s.min()) <= 1


def test_quality_stage_sends_no_rows_back(spark):
    """Texts go to Python, scores come back: whole rows do not."""
    docs = read(spark, SF, "documents").limit(20)
    model = quality.Model(np.linspace(-1, 1, 1 << quality.BITS, dtype=np.float32), 0.1, 1.0, 0.2)
    scored = quality.with_score(docs, model, "s")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan
    got = {r["doc_id"]: r["s"] for r in scored.collect()}
    assert got == {r["doc_id"]: r["score"] for r in quality.score(docs, model, ["doc_id"]).collect()}


def test_pipeline_runs(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "similar", "leaks", "mix", "shards"]
    docs = read(spark, SF, "documents")
    good = corpus_pipeline.keep_quality(spark, docs, SF)
    marked = good.join(read(spark, SF, "labels"), "doc_id").groupBy("quality").count().toPandas().set_index("quality")["count"]
    assert marked.get(0, 0) <= 0.3 * marked[1] and good.columns == docs.columns
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.run(spark, SF).count() > 0
