"""Stages of the pipeline against what their operators say, and clashing columns."""

import corpus_pipeline
from pyspark.sql import functions as F

from tidemark.llm import common

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = common.table(spark, SF, "documents").withColumns({"kept": F.lit("mine"), "score": F.lit(7), "n_words": F.lit(None).cast("int")})
    labels = {r.doc_id: r for r in common.table(spark, SF, "labels").collect()}
    before = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.stored(stage(spark, docs, SF), "stage")
        assert out.columns == docs.columns, name
        after = {r.doc_id for r in out.collect()}
        assert after < before
        if name == "quality rules":
            assert not any(d in labels and labels[d].quality == 0 for d in after)
        if name == "toxicity":
            lost = before - after
            assert all(labels[d].toxic for d in lost if d in labels)
        docs, before = out, after
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in placed} == before


def test_empty_documents(spark):
    docs = common.table(spark, SF, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_one_row_of_each_group_whatever_its_id(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text), (1, text), (None, text), (1, "other words that are here alone " * 3), (None, None), (None, ""), (4, text + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_row0": F.lit(1), "component_id": F.lit("x"), "n_shingles": F.lit("y")}).coalesce(1)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, len(r.text or "")) for r in kept.collect()) == sorted([(1, len(text)), (1, 96), (0, 0), (0, 0)])


def test_null_and_repeated_rows_go_through(spark):
    docs = common.table(spark, SF, "documents").limit(200)
    kinds = {f.name: f.dataType for f in docs.schema}
    odd = [docs.limit(1).withColumn("text", F.lit(t).cast("string")).withColumn("doc_id", F.lit(i).cast(kinds["doc_id"])) for t, i in ((None, 1), ("", None), ("a b " * 50_000, None))]
    docs = docs.union(docs.limit(20))
    for o in odd:
        docs = docs.union(o)
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, SF), "odd-stage")
        assert docs.count() > 0, name


def test_rows_stay_where_they_are_for_many_copies(spark, monkeypatch):
    """The rows that are kept are told by ranges of their numbers, with no shuffle of texts however many copies go."""
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    docs = spark.createDataFrame([(k, text(k // 3)) for k in range(60)], "doc_id long, text string").repartition(5).cache()
    plans, picked = [], common.picked

    def spied(wide, keys, column, how="left_semi"):
        out = picked(wide, keys, column, how, most=7)
        if "text" in wide.columns:
            plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(common, "picked", spied)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert sorted(r.doc_id // 3 for r in kept.collect()) == list(range(20))
    assert len(plans) == 1
    assert plans[0].count("BroadcastHashJoin") > 2
    assert "hashpartitioning" not in plans[0]
    docs.unpersist()
