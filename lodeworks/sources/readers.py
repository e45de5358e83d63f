"""Readers for the text formats the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.operators.skew import broadcast_if_small

WHITESPACE = r"\s+"


def _fields(spark: SparkSession, path: str) -> DataFrame:
    """`parts`: the whitespace-separated fields of every line that is not blank."""
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", WHITESPACE, " ")).alias("line"))
    return lines.where(F.col("line") != "").select(F.split("line", " ").alias("parts"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """`line_no, value`: lines with their number from 0, in order of file and position.

    Each file split counts its own lines; the offsets of the splits are a running
    sum over one row per split. The lines themselves are not sorted or shuffled.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seq"),
    )
    splits = lines.groupBy("file", "start").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("file", "start", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return lines.join(broadcast_if_small(offsets), ["file", "start"]).select(
        (F.col("seq") - F.col("first") + F.col("offset")).alias("line_no"), "value"
    )


def read_adjacency(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """`edges(src, dst)` and `vertices(id)` from lines `id f1,f2,...`; the list may be missing."""
    parts = _fields(spark, path)
    vertices = parts.select(F.col("parts")[0].cast("bigint").alias("id"))
    edges = parts.where(F.size("parts") == 2).select(
        F.col("parts")[0].cast("bigint").alias("src"),
        F.explode(F.split(F.col("parts")[1], ",").cast("array<bigint>")).alias("dst"),
    )
    return edges, vertices


def read_baskets(spark: SparkSession, path: str) -> DataFrame:
    """`basket_id, item`: one basket per line, items separated by whitespace.

    The ids only tell the lines apart; a repeated item stays repeated.
    """
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("basket_id"), "value")
    items = lines.select("basket_id", F.explode(F.split("value", WHITESPACE)).alias("item"))
    return items.where(F.col("item") != "")


def read_csv_vectors(spark: SparkSession, path: str) -> DataFrame:
    """`id, v`: one comma-separated vector per line, id = line number from 0."""
    return numbered_lines(spark, path).select(
        F.col("line_no").alias("id"),
        F.transform(F.split("value", ","), lambda x: F.trim(x).cast("double")).alias("v"),
    )


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """`id, v`: one whitespace-separated vector per line; the ids only tell the lines apart."""
    return _fields(spark, path).select(
        F.monotonically_increasing_id().alias("id"),
        F.col("parts").cast("array<double>").alias("v"),
    )


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """`cid, c`: one whitespace-separated vector per line, cid = line number from 0."""
    return numbered_lines(spark, path).select(
        F.col("line_no").cast("int").alias("cid"),
        F.split(F.trim("value"), WHITESPACE).cast("array<double>").alias("c"),
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """`pos, user, item, rating`: lines `user item rating`, pos = line number from 0.

    A line of other than three fields is an error that names it.
    """
    parts = numbered_lines(spark, path).select("line_no", F.split(F.trim("value"), WHITESPACE).alias("parts"))
    fault = F.raise_error(F.format_string("line %d is not `user item rating`", "line_no")).cast("boolean")
    return parts.where(F.when(F.size("parts") == 3, True).otherwise(fault)).select(
        F.col("line_no").alias("pos"),
        F.col("parts")[0].cast("bigint").alias("user"),
        F.col("parts")[1].cast("bigint").alias("item"),
        F.col("parts")[2].cast("double").alias("rating"),
    )


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """`user, item, r`: the non-zero cells of a dense matrix, row and column numbers from 0."""
    rows = numbered_lines(spark, path).select(
        F.col("line_no").alias("user"), F.split(F.trim("value"), WHITESPACE).alias("cells")
    )
    cells = rows.select("user", F.posexplode("cells").alias("item", "r"))
    return cells.select("user", F.col("item").cast("bigint").alias("item"), F.col("r").cast("bigint").alias("r")).where(
        F.col("r") != 0
    )


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """`item, title`: one title per line without its first and last character, item = line number."""
    return numbered_lines(spark, path).select(
        F.col("line_no").alias("item"),
        F.expr("substring(trim(value), 2, greatest(length(trim(value)) - 2, 0))").alias("title"),
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
