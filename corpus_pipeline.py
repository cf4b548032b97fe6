"""A corpus from raw documents to packed training sequences, in five stages.

Each stage reads what its predecessor wrote. Stages 1 to 4 return the columns
of `documents`; the last returns one row per packed piece, with its token ids;
`packing.sequences` joins them to padded sequences. Null texts and ids, repeated
rows and empty tables pass every stage as its operator states.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.llm import decontamination, near_duplicates, packing, personal_data, toxicity
from meterline.llm.common import table, written


def toxic_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.acceptable(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.keep_first(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return personal_data.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("toxicity", toxic_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
