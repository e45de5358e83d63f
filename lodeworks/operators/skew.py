"""Pairs inside groups, with hot groups split so that no task gets a whole one."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.operators.checkpoints import scratch_path, store

# A group larger than this is cut into blocks of about this many members, so one
# task row holds at most two blocks.
BLOCK_ROWS = 1024

# Rows that one task of a growing step makes, about.
ROWS_PER_PARTITION = 4_000_000

# Row limit under which a table of short rows may be broadcast.
BROADCAST_ROWS = 500_000


def is_small(rows: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether `rows` has at most `max_rows` rows; counting is a job of its own."""
    return rows.count() <= max_rows


def broadcast_if_small(rows: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Keep a small result for reuse; hint a broadcast only if a count allows it.

    A larger table is left to the adaptive planner, which joins it by shuffle
    and splits skewed partitions.
    """
    kept = rows.persist()
    return F.broadcast(kept) if is_small(kept, max_rows) else kept


@dataclass(frozen=True)
class GroupSizes:
    """`hot`: `keys, _n` of the groups to split, if any; `pairs`: pairs in all groups."""

    hot: DataFrame | None
    pairs: float
    groups: int


def partitioned(rows: DataFrame, keys: Sequence[str], results: float) -> DataFrame:
    """`rows` hashed by `keys` into parts that make a fair share of `results` rows each.

    A small input can make many rows, so the number of bytes, by which the
    adaptive planner merges partitions, says little about the work.
    """
    if results < ROWS_PER_PARTITION / 20:
        return rows
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(usual, math.ceil(results / ROWS_PER_PARTITION)), *keys)


def group_sizes(rows: DataFrame, keys: Sequence[str], block_rows: int = BLOCK_ROWS) -> GroupSizes:
    """How many pairs the groups make, and which groups have more than `block_rows` rows.

    A job of its own: a count per group, combined before the shuffle. Most data
    has no hot group, and then the plan that makes the pairs needs no join and
    no copies. Otherwise the hot groups are stored as a table, all of them, so that no
    later step counts again; it is broadcast if the job has counted few enough.
    """
    n = F.col("_n")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(
        F.sum(n * (n - 1) / 2).alias("pairs"),
        F.count(F.lit(1)).alias("groups"),
        F.count_if(n > block_rows).alias("hot"),
    ).first()
    pairs = float(total["pairs"] or 0)
    if not total["hot"]:
        return GroupSizes(None, pairs, total["groups"])
    hot = store(sizes.where(n > block_rows), scratch_path(rows.sparkSession, "hot-groups"))
    return GroupSizes(F.broadcast(hot) if total["hot"] <= BROADCAST_ROWS else hot, pairs, total["groups"])


def _blocks(
    rows: DataFrame, keys: list[str], member: str, entry: Column, sizes: GroupSizes, block_rows: int, repeats: bool
) -> DataFrame:
    """`keys, _left, _right`: one row per pair of blocks; no `_right` within a block."""
    gather = F.collect_set if repeats else F.collect_list
    placed = (
        rows.join(sizes.hot, keys, "left")
        .withColumn("_blocks", F.coalesce(F.ceil(F.col("_n") / block_rows), F.lit(1)).cast("int"))
        .select(
            *keys,
            entry.alias("_entry"),
            F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int").alias("_mine"),
            F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"),
        )
    )
    placed = placed.withColumns({"_lo": F.least("_mine", "_other"), "_hi": F.greatest("_mine", "_other")})
    return (
        partitioned(placed, [*keys, "_lo", "_hi"], sizes.pairs)
        .groupBy(*keys, "_lo", "_hi")
        .agg(
            gather(F.when(F.col("_mine") <= F.col("_other"), F.col("_entry"))).alias("_left"),
            gather(F.when(F.col("_mine") > F.col("_other"), F.col("_entry"))).alias("_right"),
        )
        .withColumn("_right", F.when(F.col("_lo") < F.col("_hi"), F.col("_right")))
    )


def pairs_within(
    rows: DataFrame,
    keys: Sequence[str],
    member: str,
    sizes: GroupSizes,
    carry: str | None = None,
    block_rows: int = BLOCK_ROWS,
    repeats: bool = False,
) -> DataFrame:
    """Every unordered pair of members that share a group, once per group.

    The result has the key columns, `a` < `b`, and `wa`, `wb` when a `carry`
    column is given. `rows` holds each (keys, member) once; with `repeats` it
    may hold it more often and the copies count as one. `sizes` is what
    `group_sizes` says about the same rows and keys, or about a superset.

    A group of m members, m > block_rows, is cut into ceil(m / block_rows)
    blocks by hash. Each pair of blocks is a group of its own, so no array here
    exceeds one block and the pairs of one hot group are made by many tasks.
    """
    keys = list(keys)
    entry = F.col(member) if carry is None else F.struct(F.col(member).alias("m"), F.col(carry).alias("w"))
    if sizes.hot is None:
        gather = F.collect_set if repeats else F.collect_list
        grouped = partitioned(rows, keys, sizes.pairs).groupBy(*keys).agg(gather(entry).alias("_left"))
        grouped = grouped.withColumn("_right", F.lit(None).cast(grouped.schema["_left"].dataType))
    else:
        grouped = _blocks(rows, keys, member, entry, sizes, block_rows, repeats)
    if carry is None:
        later = F.coalesce("_right", F.slice("_left", F.col("_pos") + 2, F.size("_left")))
        pairs = grouped.select("*", F.posexplode("_left").alias("_pos", "_x")).select(
            *keys, "_x", F.explode(later).alias("_y")
        )
        return pairs.select(*keys, F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"))

    # Members and weights as arrays of their own, paired up by position.
    columns = grouped.select(
        *keys,
        F.col("_left.m").alias("_xm"),
        F.col("_left.w").alias("_xw"),
        F.coalesce("_right.m", "_left.m").alias("_ym"),
        F.coalesce("_right.w", "_left.w").alias("_yw"),
        F.col("_right").isNull().alias("_within"),
    )
    first = columns.select("*", F.posexplode("_xm").alias("_i", "_x"))
    start = F.when(F.col("_within"), F.col("_i") + 1).otherwise(0)
    end = F.size("_ym") - 1
    both = first.where(start <= end).select("*", F.explode(F.sequence(start, end)).alias("_j"))
    y, wx, wy = F.col("_ym")[F.col("_j")], F.col("_xw")[F.col("_i")], F.col("_yw")[F.col("_j")]
    in_order = F.col("_x") < y

    def pick(one: Column, other: Column) -> Column:
        return F.when(in_order, one).otherwise(other)

    return both.select(
        *keys,
        F.least("_x", y).alias("a"),
        F.greatest("_x", y).alias("b"),
        pick(wx, wy).alias("wa"),
        pick(wy, wx).alias("wb"),
    )
