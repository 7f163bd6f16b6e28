import os

import pytest

import corpus_pipeline
from perispark.llm import quality, secrets, simhash, toxicity
from tests.llm.helpers import documents, edge_documents
from tests.llm.test_classifiers import LABELS, labelled


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of a small corpus: labelled texts, edge rows, copies, secrets."""
    path = str(tmp_path_factory.mktemp("sf"))
    rows, labels = labelled(300)
    rows += edge_documents() + [(5000 + i, rows[7][1], "en", "s", 1) for i in range(5)] + [(6000, rows[8][1] + " token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"", "en", "s", 1)]
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_keep_columns_and_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        out = os.path.join(folder, "out", name)
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == seen["documents"].columns
    ids = {name: sorted((r.doc_id is not None, r.doc_id or 0) for r in df.select("doc_id").collect()) for name, df in seen.items()}
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = [r for r in toxicity.score(seen["documents"], labels).collect() if not r.predicted]
    assert ids["toxicity"] == sorted((r.doc_id is not None, r.doc_id or 0) for r in kept)
    kept = [r for r in quality.score(seen["toxicity"], labels).collect() if r.predicted]
    assert ids["quality"] == sorted((r.doc_id is not None, r.doc_id or 0) for r in kept)
    groups = simhash.rooted(seen["quality"])[1].select("root").distinct().count()  # an id may name several groups
    assert len(ids["near_duplicates"]) == groups < len(ids["quality"])
    assert ids["secrets"] == ids["near_duplicates"]
    assert secrets.report(seen["secrets"]).where("spans <> ''").count() == 0
    assert sorted(set(ids["packing"])) == sorted(set(ids["secrets"]))
    assert all(r.length <= 2048 for r in seen["packing"].collect())


def test_run_gives_the_last_stages_rows(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert set(found.columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} and found.count() > 0


@pytest.mark.parametrize("empty", ["documents", "labels", "both"])
def test_stages_bear_empty_tables(spark, folder, tmp_path, empty):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.where("false") if empty != "labels" else docs.limit(60)
    (labels.where("false") if empty != "documents" else labels).write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, kept, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert found.columns == docs.columns
        if empty != "labels":
            assert found.count() == 0
        elif name in ("toxicity", "quality"):
            assert found.count() == kept.count()  # nothing is learned, nothing goes


def test_stages_bear_columns_of_their_own_making(spark, folder):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(80)
    for name in ("_spans", "_every", "_weak", "_score_", "_keep_bits", "_keep_key", "pieces", "start", "ids_crc32", "sequence_id", "component_id"):
        docs = docs.withColumn(name, F.lit("clash"))
    kept = docs.where("doc_id IS NOT NULL AND doc_id >= 1000")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, kept, folder)
        assert found.columns == docs.columns and found.where("_spans <> 'clash' OR component_id <> 'clash'").count() == 0
