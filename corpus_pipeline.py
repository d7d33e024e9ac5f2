"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and read
again as the next stage's documents.  All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fairspark.llm.decontaminate import decontamination_stage
from fairspark.llm.near_duplicates import near_duplicate_stage
from fairspark.llm.packing import packed_digest
from fairspark.llm.quality_rules import quality_stage
from fairspark.llm.repeats import repeats_stage
from fairspark.llm.shared import stage, table


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences, one row per piece of a document."""
    return packed_digest(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("repeated passages", repeats_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: No SQL: quality scores, tokens and packing are outside it (tests hold each stage to brute force).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
