"""The corpus pipeline: one operator a stage, each written as Parquet and read again by the next.

In every stage null texts count as empty ones, null doc_ids are ids like others, empty and very long texts are judged
whole, rows that repeat are judged alike (only the near-duplicate stage takes repeats out), further columns are passed on
whatever they are called, and an empty table gives an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, packing, quality, simhash, suffix_dedup
from lodestone.llm.common import fresh, table, workspace
from lodestone.llm.queries import tokenizer
from lodestone.shipping import ship


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (a score under 0.7) go. It is fitted on labelled documents of its input, none of them held out."""
    ship(spark)
    (score,) = fresh(docs.columns, "score")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")), score)
    return scored.where(F.col(score) >= 0.7).drop(score)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    ship(spark)
    return simhash.keep_one(docs)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in stretches of 200 that start anywhere else, too, go from the texts; n_chars counts what is left. No document goes."""
    ship(spark)
    (own,) = fresh(docs.columns, "own_spans")  # the operator adds a column of that name
    left = suffix_dedup.remove_repeats(docs.withColumnRenamed("spans", own)).drop("spans").withColumnRenamed(own, "spans")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*[f"`{c}`" for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more lies in benchmark windows go."""
    ship(spark)
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024: one row a piece, with its ids and its place."""
    ship(spark)
    return packing.pack(packing.cut(docs, tokenizer))


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("suffix-array dedup", repeats_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]
#: Trees, links and bins can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{workspace(spark)}/pipeline-{uuid.uuid4().hex}-{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
