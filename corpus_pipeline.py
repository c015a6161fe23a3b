"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

The stages are described in :mod:`airnet.llm.stages`; 1 to 4 return the columns of their input.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airnet.llm import stages
from airnet.llm.common import documents
from airnet.session import scratch_path

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", stages.quality_rules),
    ("line_dedup", stages.line_dedup_stage),
    ("near_copies", stages.near_copies_stage),
    ("decontamination", stages.decontamination),
    ("packing", stages.packing),
]

ORACLE_SQL = None  # robust estimates and banding have no SQL form; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    base = scratch_path(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
