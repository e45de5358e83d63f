"""Operators as pipeline stages: documents in, documents out.

Only `doc_id`, `source` and `text` are given to an operator; the other columns of a row
travel with it in one struct, so no name of theirs can meet a name of the operator's.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import keep, numbered, scratch_path, table
from lodeworks.llm.decontaminate import matched
from lodeworks.llm.host_rules import host_verdicts, judge, measured
from lodeworks.llm.mixing import drawn, mix, size_of, sized
from lodeworks.llm.near_dedup import deduplicated
from lodeworks.llm.token_shards import manifest, public_vocabulary, write_shards

USED = ["doc_id", "source", "text"]


def _apart(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`step` on the three columns, with the columns of `docs` again, in their order."""
    others = [c for c in docs.columns if c not in USED]
    carried = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(0)
    rows = step(docs.select(*USED, carried.alias("_others")))
    back = [F.col(c) if c in USED else F.col("_others").getField(c).alias(c) for c in docs.columns]
    return rows.select(back)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail by themselves nor come from a failing source."""


    def step(d: DataFrame) -> DataFrame:
        # Measured twice rather than stored with the texts: a row of two short columns is enough for the hosts.
        seen = measured(d)
        hosts = keep(host_verdicts(keep(seen.select("source", "base_failed"), "stage-rules")), "stage-hosts")
        return judge(seen, verdicts=hosts).where("kept")

    return _apart(docs, step)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return _apart(docs, deduplicated)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word in a window of a benchmark item."""
    benchmark = table(spark, sf_dir, "benchmark")
    return _apart(docs, lambda d: matched(d, benchmark).where(F.size("spans") == 0))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix draws from each document, a row for each time; `n_chars` is that of the new text."""


    def step(d: DataFrame) -> DataFrame:
        # Sizes are stored, texts are not: their rows are found again by their places in the files.
        rows = numbered(d, "stage-mix")
        sizes = keep(rows.select("_row", "doc_id", "source", size_of("text").alias("size")), "stage-sizes")
        if sizes.count() > sizes.select("_row").distinct().count():
            rows = keep(sized(d), "stage-mix")
            sizes = rows.select("_row", "doc_id", "source", "size")
        return drawn(replace(mix(sizes), docs=rows))

    rows = _apart(docs, step)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards in training order, and their manifest."""
    shards, spans = write_shards(docs.select("doc_id", "text"), public_vocabulary(), scratch_path(spark, "shards"))
    return manifest(spark, shards, spans)
