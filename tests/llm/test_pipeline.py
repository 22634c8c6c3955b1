import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gramloom.llm import bpe, secrets

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages_keep_the_columns_and_what_they_should(spark, small, tmp_path):
    docs = small
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(n)))
        after = spark.read.parquet(str(tmp_path / str(n)))
        assert after.columns == small.columns and after.dtypes == small.dtypes
        assert 0 < after.count() <= 2 * docs.count()
        docs = after
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    last = corpus_pipeline.tokenised(spark, docs, SF)
    assert {r["doc_id"] for r in last.select("doc_id").collect()} <= ids
    assert last.where("n_tokens != size(ids)").count() == 0


def test_copies_go_and_secrets_are_covered(spark, documents, awkward):
    text = "this is a text of more than five words that is here twice"
    docs = documents(*awkward, (10, text), (11, text), (12, "the token = 'abcdefghij0123456789' is known"))
    kept = corpus_pipeline.without_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 10, 12, 2, 3, 4, 5, 6, 7, None]
    covered = {r["doc_id"]: r for r in corpus_pipeline.without_secrets(spark, docs, SF).collect()}
    assert covered[12]["text"] == "the [ASSIGN]' is known" and covered[12]["n_chars"] == 22
    assert covered[10]["text"] == text and covered[1]["text"] is None and covered[10]["n_chars"] == 1
    assert corpus_pipeline.without_secrets(spark, docs, SF).count() == docs.count()


def test_copies_inside_a_crowd_go_and_the_crowd_stays(spark, documents, crowd):
    kept = corpus_pipeline.without_copies(spark, documents(*crowd(400, 40)), SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2 * i for i in range(400)]


def test_empty_tables_pass(spark, documents):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(), SF).count() == 0
