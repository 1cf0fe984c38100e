"""The pipeline's stages against brute force over what their predecessor kept."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from stockweave.llm import decontaminate, mixing, pii
from stockweave.llm.common import read_table

from .brute import brute_components


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = read_table(spark, sf_dir, "documents"), []
    for name, stage in pipeline.STAGES:
        new = stage(spark, docs, sf_dir).persist()
        out.append((name, docs, new))
        docs = new
    return {name: (before, after) for name, before, after in out}


def test_all_but_the_last_return_documents(stages):
    for name, (before, after) in stages.items():
        assert name == "mixing" or after.columns == before.columns


def test_language_keeps_clean_documents(stages):
    before, after = stages["language_id"]
    assert after.count() >= 0.99 * before.count()


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_dedup"]
    want = {i for i, (_, c) in brute_components([(r["doc_id"], r["text"]) for r in before.collect()]).items() if i == c}
    assert {r["doc_id"] for r in after.collect()} == want


def test_passages_go(spark, sf_dir, stages):
    before, after = stages["decontamination"]
    items = [(r["item_id"], decontaminate.normal(r["text"])) for r in read_table(spark, sf_dir, "benchmark").collect()]
    kept = {r["doc_id"] for r in after.collect()}
    for r in before.collect():
        if any(x in decontaminate.normal(r["text"]) for _, x in items):
            assert r["doc_id"] not in kept
    assert len(kept) >= 0.9 * before.count()


def test_no_base_span_is_left(stages):
    before, after = stages["pii"]
    assert after.count() == before.count()
    for r in after.collect():
        assert pii.base_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])


def test_mixing_draws_copies(stages):
    before, after = stages["mixing"]
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(before).collect() if r["copies"] > 0}
    assert {r["doc_id"]: r["copies"] for r in after.collect()} == want


def test_empty_and_odd_documents(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _id string, copies int"
    rows = [(1, None, None, None, None, "a", 1), (None, "some text of words", "en", None, 5, None, None), (2, "", "en", "s", 0, "b", 2), (2, "", "en", "s", 0, "b", 2)]
    for given in ([], rows):
        docs = spark.createDataFrame(given, schema)
        for name, stage in pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
            assert name == "mixing" or docs.columns == [f.split()[0] for f in schema.split(", ")]
            docs.count()


def test_run_equals_its_stages(spark, sf_dir, stages):
    got = pipeline.run(spark, sf_dir).agg(F.count("*"), F.sum("doc_id"), F.sum("copies")).first()
    assert tuple(got) == tuple(stages["mixing"][1].agg(F.count("*"), F.sum("doc_id"), F.sum("copies")).first())
