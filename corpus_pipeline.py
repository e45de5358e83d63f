"""A corpus pipeline: each stage's rows are written as Parquet and read again by the next.

The last stage's tokens and the near duplicates' hashes are not to be had in SQL, so there
is no ORACLE_SQL; tests/llm holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodeworks.llm import stages
from lodeworks.llm.common import keep, table

STAGES = [
    ("quality rules", stages.quality_rules),
    ("near duplicates", stages.near_dedup),
    ("benchmark decontamination", stages.decontaminate),
    ("mixing", stages.mixing),
    ("token shards", stages.token_shards),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
