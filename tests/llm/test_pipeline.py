"""The registered queries and the pipeline on the small test tables."""

import pytest
from oracle import connect, differences

import corpus_pipeline
from cohortflow.llm import line_dedup
from cohortflow.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_covers_its_table(spark, name):
    rows = QUERIES[name](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert rows.count() > 0
    if "doc_id" in rows.columns:
        assert rows.select("doc_id").distinct().count() == docs


def test_there_is_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    columns, start = docs.columns, docs.count()
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF_DIR)
        if name != "packing":
            assert docs.columns == columns
            docs = docs.cache()
        counts.append(docs.count())
        if name in ("quality_rules", "mixing"):
            good = {r.doc_id for r in before.select("doc_id").collect() if r.doc_id in labels}
            good = {d for d in good if labels[d].quality == 1 and labels[d].toxic == 0}
            left = {r.doc_id for r in docs.select("doc_id").collect()}
            # Few labels here; test_mixing_keeps_good_documents holds the loss where there are more.
            assert len(good & left) >= 0.85 * len(good)
        if name == "line_dedup":
            # Documents go only if nothing is left of them.
            gone = before.join(docs, "doc_id", "left_anti")
            left = line_dedup.drop_repeated_lines(before).join(gone.select("doc_id"), "doc_id", "left_semi")
            assert all(not r.text.strip() for r in left.collect()) and gone.count() > 0
    assert start > counts[0] > counts[1] >= counts[2]
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert packed.columns == docs.columns and packed.count() > 0


def test_mixing_keeps_good_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = QUERIES["op2_mixing"](spark, sf_dir).join(labels, "doc_id").where("quality = 1 and toxic = 0")
    copies = [r.copies for r in good.select("copies").collect()]
    assert len(copies) > 250 and sum(c == 0 for c in copies) <= 0.02 * len(copies)
