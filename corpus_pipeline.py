"""From raw documents to a training mix, one stage after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventmill.llm import stages
from eventmill.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.toxicity),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("suffix_array_dedup", stages.suffix_array_dedup),
    ("benchmark_decontamination", stages.benchmark_decontamination),
    ("mixing", stages.mixing),
]

#: SQL has neither fitted weights nor suffix orders; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's rows are written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
