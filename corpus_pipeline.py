"""Corpus pipeline: quality rules, near duplicates, benchmark decontamination, mixing, sharding.

`run` applies the stages to `documents`; each stage works on all that its predecessor kept, which is written and read
back between stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aduana.llm.common import importable, written
from aduana.llm.stages import STAGES as _STAGES

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = list(_STAGES)

#: Classifier, similarity search and random rounding are not expressible in SQL; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = importable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
