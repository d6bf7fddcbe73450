"""The corpus pipeline: documents cleaned and packed in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.  ``run`` writes each stage's rows to the
shared folder and reads them back as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from strata.llm.common import documents, scratch, table
from strata.llm.queries import vocabulary


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines alike to an earlier line go; documents of which nothing is left too."""
    return line_dedup.without_alike_lines(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more of their five-word
    shingles, the one with the least doc_id stays."""
    return ngram_join.without_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items go; documents that are mostly such passages too."""
    return decontaminate.remove_items(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece with its place in a sequence of at most 2048 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_join_stage),
    ("decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: Learned scores and tokenizers have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(table(spark, sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
