"""The corpus pipeline: documents through the stages of STAGES, each written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from airwave.llm.common import table
from airwave.llm.exact import drop_exact_duplicates
from airwave.llm.jaccard import drop_near_duplicates
from airwave.llm.language import fit, keep_known
from airwave.llm.packing import pack
from airwave.session import shared_dir, stage_scratch
from airwave.sinks.files import remove


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with enough confidence; others go."""
    return keep_known(docs, fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space, the one with the smallest doc_id."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share most five-word shingles, directly or in steps, the smallest doc_id."""
    return drop_near_duplicates(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training windows of the kept documents; token ids stay with their pieces.

    Earlier stages have filled the executors' heaps, so Python workers take less at once and keep fewer words.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return pack(docs, remembered=24 << 20, chunk=1 << 20)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", pack_windows),
]

#: Language ID and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of `sf_dir`.

    Each stage is written to the shared folder, so a lost executor costs at most the stage's own tasks. What a
    stage keeps on the way goes once it is written, and so does its input. An empty table passes
    through all stages and gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        with stage_scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
