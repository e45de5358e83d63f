"""Small helpers that several of these operators share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.operators.checkpoints import discard, scratch_path

__all__ = ["Scratch", "discard", "keep", "let", "numbered", "scratch_path", "sliced", "small", "table"]

# Rows of a table that may be broadcast, each of a few dozen bytes.
BROADCAST_ROWS = 200_000
# Files whose paths are listed; a table of more is copied instead.
MAX_FILES = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(rows: DataFrame, name: str) -> DataFrame:
    """`rows` as a table in the shared folder: computed once, and lost executors cost nothing."""
    return _stored(rows, scratch_path(rows.sparkSession, name))


def _stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """`rows` with `_row`, the same number in every scan: a row's place in its Parquet file, or in a stored copy.

    Files are numbered by their paths. Rows that were joined or exploded since they were read may share
    a place, so that the caller counts them.
    """
    spark = rows.sparkSession
    try:
        placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    except AnalysisException:  # not read from Parquet files
        return keep(rows.withColumn("_row", F.monotonically_increasing_id()), name)
    files = [r["_file"] for r in placed.select("_file").distinct().limit(MAX_FILES + 1).collect()]
    if len(files) > MAX_FILES:
        return keep(rows.withColumn("_row", F.monotonically_increasing_id()), name)
    listed = spark.createDataFrame([(f, i) for i, f in enumerate(sorted(files))], "_file string, _number bigint")
    row = F.shiftleft("_number", 40) + F.col("_at")
    return placed.join(F.broadcast(listed), "_file").withColumn("_row", row).drop("_file", "_at", "_number")


class Scratch:
    """Tables that one computation keeps, and deletes when its result is stored."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        self.paths.append(scratch_path(self.spark, name))
        return _stored(rows, self.paths[-1])

    def clear(self) -> None:
        while self.paths:
            discard(self.spark, self.paths.pop())


def small(rows: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if a count shows that it is small; else leave the join to the planner."""
    return F.broadcast(rows) if rows.count() <= max_rows else rows


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, also where `body` uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def parts_for(rows: int, per_part: int) -> int:
    """The number of parts, a power of two, that hold `per_part` rows each at most, about."""
    return 1 << max(0, math.ceil(math.log2(max(1, rows) / per_part)))


def sliced(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about `most_bytes` of one column's text; a longer text is a piece of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(lengths, dtype=np.int64), 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + most_bytes, "right")))
            yield batch.slice(start, end - start)
            start = end
