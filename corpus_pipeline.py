"""Documents to packed training sequences: toxicity, lines, near duplicates, private data, packing.

In all stages: null and empty texts stay as they are until the last, which packs their end mark alone; rows with a null id
stay, and are neither duplicates nor have any; rows that repeat an id stay together in what is decided by id; ties go to
the smaller id, then the first place; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import lines, near_dedup, packing, private, toxicity
from tessera.llm.scratch import Scratch


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Without any label nothing is toxic."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; every document stays, if with an empty text."""
    return lines.dedup_lines(docs).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    return near_dedup.drop_near_duplicates(docs)


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private data gives way to pseudonyms; equal values stay linked."""
    return private.pseudonymize(docs, private.key_of(spark)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2,048 tokens; each row is packed, repeated ones too."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("lines", lines_stage),
    ("near duplicates", near_stage),
    ("private data", private_stage),
    ("packing", packing_stage),
]

#: No SQL says what the classifier, the fuzzy lines and the linear program of the stages do.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages; each stage's result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.keep(docs)
    return docs
