"""A training-corpus pipeline: five stages, each one of the operators of ``folioforge.llm`` on all its predecessor kept.

Every stage's rows are written as Parquet and read again before the next one starts, so a lost executor never costs more
than the stage at hand.  All stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm.common import Scratch
from folioforge.llm.exact_dedup import keep_one as keep_one_copy
from folioforge.llm.jaccard_join import keep_one as keep_one_near
from folioforge.llm.language_id import identified_documents
from folioforge.llm.mixing import mixed_documents
from folioforge.llm.packing import pack
from folioforge.llm.queries import vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter go, and lang is filled in where it is null."""
    return identified_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return keep_one_copy(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 or more on five-word shingles, the smallest doc_id stays."""
    return keep_one_near(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source near its target; a document is there as often as the mix takes it."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens.

    The encoder's cache is a quarter of the operator's own, as the executors' heaps are full from the stages before.
    """
    return pack(docs, vocabulary(), max_chunks=200_000)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("source_mixing", mixture),
    ("mixture_packing", packing),
]

#: SQL can express neither rank-order profiles nor the tokenizer's ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over sf_dir's documents.

    A stage's table is dropped once the next one is written, the last one once the rows are kept as a checkpoint.  Nulls,
    empty and very long texts, ties, repeated rows and columns of other names are as each stage's operator says; an empty
    table gives no rows.
    """
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        here = Scratch(spark, f"pipeline-{name}")
        docs = here.table(stage(spark, docs, sf_dir))
        if before:
            before.drop()
        before = here
    docs = scratch.keep(docs)
    before.drop()
    return docs
