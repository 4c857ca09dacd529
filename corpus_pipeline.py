"""The corpus pipeline: quality rules, toxicity, near-duplicates, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but
the last return the columns of ``documents``; the last gives the pieces with their places.
Null and empty texts fail the quality rules; null ids teach the models nothing and are else rows
like any others; repeated rows are judged alike, and the join keeps one of them. Documents without
rows give empty results; extra columns travel along whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, jaccard_join, packing, quality_crf, toxicity


def _with_row(docs: DataFrame) -> DataFrame:
    """Key, text and the whole row as one column, so that no operator's column can clash with it."""
    return docs.select("doc_id", "text", F.struct("*").alias("_row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line labels of the CRF accept."""
    crf = quality_crf.fitted(docs, common.table(spark, sf_dir, "labels"))
    return quality_crf.judge(_with_row(docs), crf, keep=("_row",)).where("kept").select("_row.*")


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't predict as toxic; a quarter of the labels is left for measuring it."""
    model = toxicity.learn(docs, common.table(spark, sf_dir, "labels").where(common.fold("doc_id", 4) != 2))
    return toxicity.score(_with_row(docs), model, also={"_row": F.col("_row")}).where("predicted = 0").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group in the table's order: five-word shingles, Jaccard 0.8 or more.

    Rows are told apart by a number of their own, so one row of a group stays whether its ids are
    null, repeated or shared by different texts. Rows without a word are in no group and stay.
    """
    row = next(n for k in range(len(docs.columns) + 1) if (n := f"_row{k}") not in docs.columns)
    with common.Scratch() as tmp:
        rows = tmp.stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
        groups = jaccard_join.similar(rows.select(row, "text"), key=row, n=5, percent=80)
        tmp.frames.append(groups)
        copies = tmp.stored(groups.where(F.col("component_id") != F.col(row)).select(row), "copies")
        return common.stored(common.picked(rows, copies, row, "left_anti").select(docs.columns), "first-rows")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences and offsets."""
    pieces = packing.pieces_of(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return packing.pack(pieces)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_documents),
    ("n-gram Jaccard join", near_duplicates),
    ("best-fit packing", packed),
]

#: Learned models and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over what the one before it kept."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        kept = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if common.is_written(docs):
            common.forget(docs)
        docs = kept
    return docs
