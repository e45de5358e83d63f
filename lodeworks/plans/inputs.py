"""Operator inputs derived from the shared test tables.

An operator reads its input several times, so inputs that take a shuffle to
derive are kept, as a stored table would be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.operators.skew import group_sizes, pairs_within


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def friend_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`src, dst`: different parts returned in one order, both directions."""
    returned = (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select("l_orderkey", "l_partkey")
    )
    sizes = group_sizes(returned, ["l_orderkey"])
    met = pairs_within(returned, ["l_orderkey"], "l_partkey", sizes, repeats=True).select("a", "b").distinct()
    return met.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("src"), F.col("b").alias("dst")),
                F.struct(F.col("b").alias("src"), F.col("a").alias("dst")),
            )
        ).alias("e")
    ).select("e.*").persist()


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`basket_id, item`: brand, type and name of the parts of each order, with repeats."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        F.col("l_orderkey").alias("basket_id"),
        F.explode(F.array("p_brand", "p_type", "p_name")).alias("item"),
    )


def support_of(rows: DataFrame, share: float, basket: str = "basket_id") -> int:
    """The number of baskets that makes up `share` of all, rounded up."""
    return rows.agg(
        F.ceil(F.lit(share) * F.countDistinct(basket)).cast("bigint").alias("s")
    ).first()["s"]


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v")
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`user, item, rating` 1..5: mean quantity a customer took from a supplier."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    return (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_suppkey").alias("item"))
        .agg(F.ceil(F.avg("l_quantity") / 10).cast("double").alias("rating"))
        .persist()
    )


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`user, item, r = 1`: which customer took anything from which supplier."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .select(F.col("o_custkey").alias("user"), F.col("l_suppkey").alias("item"))
        .distinct()
        .withColumn("r", F.lit(1).cast("bigint"))
        .persist()
    )
