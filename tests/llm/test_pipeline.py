"""The pipeline's stages on a small corpus, and the registered queries against their SQL."""

import os
import random
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402
import corpus_pipeline  # noqa: E402
from waybill.llm import decontamination, jaccard, quality, tables, toxicity  # noqa: E402
from waybill.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars int, score double, id long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(8)
    say = lambda n: " ".join("".join(rnd.choice("bdfgkmprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4))) for _ in range(n))
    folder, rows, labels, items = tmp_path_factory.mktemp("corpus"), [], [], [(0, say(30)), (1, say(25))]
    for i in range(400):
        kind, text = i % 10, say(rnd.randint(40, 90))
        if kind == 0:
            text = text.replace(" ", " vile ", 3)
        elif kind == 1:
            text = "### %%% " * rnd.randint(10, 40) + text[:20]
        elif kind == 2:
            text = f"{text} {items[i % 2][1]} {say(5)}"
        elif kind == 3 and i > 10:
            text = rows[-10][1] + " end"  # a near copy of the row of this kind before
        rows.append((i, text, "en", "s", len(text), 0.5, i))
        if i < 250:
            labels.append((i, int(kind != 1), int(kind == 0)))
    rows += [(7, rows[7][1], None, None, None, None, None), (None, say(60), None, None, None, None, None), (500, None, "en", "s", 0, 0.1, 1),
             (501, "", "en", "s", 0, 0.1, 1), (502, say(20_000), "en", "s", 0, 0.1, 1)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, str(folder)


def test_a_stage_leaves_small_batches_and_run_puts_the_sessions_back(spark, corpus):
    before = spark.conf.get(tables.BATCH_ROWS)
    try:
        corpus_pipeline.tokenize(spark, spark.read.parquet(f"{corpus[1]}/documents.parquet"), corpus[1])
        assert int(spark.conf.get(tables.BATCH_ROWS)) <= 1000
    finally:
        spark.conf.set(tables.BATCH_ROWS, before)
    corpus_pipeline.run(spark, corpus[1])
    assert spark.conf.get(tables.BATCH_ROWS) == before


def test_stages_take_effect(spark, corpus):
    rows, folder = corpus
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.keep(stage(spark, docs, folder), "stage")
        kept.append(docs)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert set(docs.columns) == {f.split()[0] for f in DOCS.split(", ")}
    ids = [[r["doc_id"] for r in d.select("doc_id").collect()] for d in kept]
    named = lambda i: {x for x in ids[i] if x is not None and x < 400}
    assert named(0) == {i for i in range(400) if i % 10 != 0}
    assert named(1) == {i for i in named(0) if i % 10 != 1}
    assert named(2) == {i for i in named(1) if i % 10 != 3 or i == 3} and ids[2].count(7) == 1
    assert named(3) == {i for i in named(2) if i % 10 != 2}
    assert sorted(map(str, ids[4])) == sorted(map(str, ids[3])) and None in ids[4] and {500, 502} <= set(ids[4]) | {500}
    assert corpus_pipeline.run(spark, folder).count() == len(ids[4])


def test_stages_equal_their_operators_decisions(spark, corpus):
    _, folder = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 120")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    lexicon = toxicity.toxicity_model(docs, labels, F.lit(True))
    mild = {r["doc_id"] for r in docs.collect() if toxicity_of(r["text"], lexicon) < 0.7}
    assert {r["doc_id"] for r in corpus_pipeline.remove_toxic(spark, docs, folder).collect()} == mild
    groups = jaccard.similarity_groups(docs).filter("doc_id = component_id")
    assert {r["doc_id"] for r in corpus_pipeline.keep_one_of_each_group(spark, docs, folder).collect()} == {
        r["doc_id"] for r in groups.collect()}


def toxicity_of(text, lexicon):
    import numpy as np

    total, words = toxicity.counted(toxicity.fold_text(text), lexicon.matcher())
    x = toxicity._features(np.array([total]), np.array([words]))[0]
    a, b, c = lexicon.curve
    return 1 / (1 + np.exp(-(a * x[0] + b * x[1] + c)))


def test_empty_input(spark, corpus):
    docs = spark.read.parquet(f"{corpus[1]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, corpus[1])
        assert docs.count() == 0


@pytest.mark.parametrize("value", [0, 1])
def test_labels_of_one_value_reject_nothing(spark, tmp_path, value):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(6)], "doc_id long, text string")
    spark.createDataFrame([(i, value) for i in range(3)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.keep_good(spark, docs, str(tmp_path)).count() == 6


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(entry.oracle_sql())))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    verdict = compare.compare(spark, db, name, QUERIES[name], entry.oracle_sql()[name], SF)
    assert verdict.startswith("ok"), verdict


def test_registered(spark):
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert not any(hasattr(module, "localCheckpoint") for module in (decontamination, jaccard, quality))
