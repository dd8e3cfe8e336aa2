"""The corpus pipeline: toxicity, exact dedup, near dedup, decontamination, packing.

Each stage works on all that the stage before it kept, and its decisions take effect: all but the
last return the columns of ``documents`` with the rows that stay. Nulls, empty tables and other
columns are handled as the operators in ``cabflow.llm`` state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cabflow.llm import common, decontaminate, exact_dedup, near_dedup, packing, queries, toxicity


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go. It is fitted on the labelled documents that
    reached this stage and are not held out."""
    scorer = queries.toxicity_scorer(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, scorer)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    common.prepare(spark)
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest doc_id stays."""
    return near_dedup.drop_near_copies(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    return decontaminate.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenized and placed in sequences: one row per piece."""
    return packing.pack(docs, queries.tokenizer("word_bpe_49k.json"))


STAGES = [
    ("toxicity", clean),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontaminate", uncontaminated),
    ("packing", packed),
]

#: SQL expresses neither the classifier nor the alignment: ``tests/llm/test_pipeline.py`` compares
#: the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
