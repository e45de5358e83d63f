"""Friend recommendation: who shares many neighbours and is not yet connected."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.operators.checkpoints import scratch_path, store
from lodeworks.operators.skew import (
    BLOCK_ROWS,
    BROADCAST_ROWS,
    GroupSizes,
    broadcast_if_small,
    group_sizes,
    is_small,
    pairs_within,
    partitioned,
)

# A vertex whose list makes more pairs than this is a hub. The limit decides about time, not about rows.
HUB_PAIRS = 20_000_000
# Candidates kept for users with the same hubs; who is not served by them is computed alone.
OFFERED = 1024


def _adjacency(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """`src, dst` without self loops; an edge may still be listed twice."""
    return edges.select(F.col(src).cast("bigint").alias("src"), F.col(dst).cast("bigint").alias("dst")).where(
        F.col("src") != F.col("dst")
    )


def _counts(lists: DataFrame, sizes: GroupSizes, block_rows: int) -> DataFrame:
    wedges = pairs_within(lists, ["src"], "dst", sizes, block_rows=block_rows, repeats=True)
    # As many parts as the pairs ask for: most pairs meet once or twice, so nearly all are groups.
    wedges = partitioned(wedges.select("a", "b"), ["a", "b"], sizes.pairs)
    return wedges.groupBy(F.col("a").alias("u"), F.col("b").alias("v")).agg(F.count(F.lit(1)).alias("n"))


def mutual_friend_counts(
    edges: DataFrame, src: str = "src", dst: str = "dst", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """`u, v, n`: for u < v, the number of vertices whose list holds both."""
    lists = _adjacency(edges, src, dst)
    return _counts(lists, group_sizes(lists, ["src"], block_rows), block_rows)


def drop_connected(pairs: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """The pairs `u, v, ...` (u < v) without an edge in either direction."""
    connected = edges.select(
        F.least(src, dst).cast("bigint").alias("u"), F.greatest(src, dst).cast("bigint").alias("v")
    )
    return pairs.join(connected, ["u", "v"], "left_anti")


def _both_ways(pairs: DataFrame, one: str, other: str, names: tuple[str, str], *carried: str) -> DataFrame:
    """Each pair as two rows, `names` being (one, other) and then (other, one)."""
    a, b = names
    there = F.struct(F.col(one).alias(a), F.col(other).alias(b))
    back = F.struct(F.col(other).alias(a), F.col(one).alias(b))
    return pairs.select(F.explode(F.array(there, back)).alias("_p"), *carried).select("_p.*", *carried)


def _selected_counts(lists: DataFrame, users: DataFrame) -> DataFrame:
    """`user, candidate, n_mutual` of the given users only: two steps from each.

    `users` is broadcast by the caller where it is known to be small.
    """
    first = lists.withColumnRenamed("dst", "user").join(users, "user", "left_semi").distinct()
    middle = broadcast_if_small(first.select("src").distinct())
    second = lists.withColumnRenamed("dst", "candidate").join(middle, "src", "left_semi").distinct()
    counts = (
        first.join(second, "src")
        .where(F.col("user") != F.col("candidate"))
        .groupBy("user", "candidate")
        .agg(F.count(F.lit(1)).alias("n_mutual"))
    )
    near = _both_ways(lists, "src", "dst", ("user", "candidate")).join(users, "user", "left_semi")
    return counts.join(near, ["user", "candidate"], "left_anti")


def _pairs_of_group() -> Column:
    n = F.col("_n").cast("double")
    return n * (n - 1) / 2


def _hubs(sizes: GroupSizes, hub_pairs: float) -> DataFrame | None:
    """`src, _n`: all vertices whose lists alone would make more than `hub_pairs` pairs, if there are any."""
    if sizes.hot is None:
        return None
    hubs = sizes.hot.where(_pairs_of_group() > hub_pairs)
    return hubs if hubs.head(1) else None


def _class_overlaps(classes: DataFrame, block_rows: int) -> DataFrame:
    """`class, other, n_mutual`: hubs that two classes have in common, where there are any; itself included."""
    listed = classes.select("class", F.explode("hubs").alias("hub"))
    pairs = pairs_within(listed, ["hub"], "class", group_sizes(listed, ["hub"], block_rows), block_rows=block_rows)
    across = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_mutual"))
    itself = classes.select("class", F.col("class").alias("other"), F.size("hubs").cast("bigint").alias("n_mutual"))
    return _both_ways(across, "a", "b", ("class", "other"), "n_mutual").unionByName(itself)


def _class_lists(classes: DataFrame, members: DataFrame, offered: int, block_rows: int) -> DataFrame:
    """`class, candidate, n_mutual, more`: the first `offered` users in the order of a class; `more` if there are others.

    Classes that share fewer hubs than are needed to fill the list offer nothing, and the others
    their lowest ids.
    """
    spark = classes.sparkSession
    met = store(_class_overlaps(classes, block_rows), scratch_path(spark, "class-overlaps"))
    of_other = classes.select(F.col("class").alias("other"), "members")
    better = Window.partitionBy("class").orderBy(F.desc("n_mutual")).rowsBetween(Window.unboundedPreceding, -1)
    reach = (
        met.join(of_other, "other")
        .groupBy("class", "n_mutual")
        .agg(F.sum("members").alias("_all"), F.sum(F.least("members", F.lit(offered))).alias("_offers"))
        .withColumn("_before", F.coalesce(F.sum("_offers").over(better), F.lit(0)))
        .groupBy("class")
        .agg(F.sum("_all").alias("_all"), F.min(F.when(F.col("_before") < offered, F.col("n_mutual"))).alias("_least"))
        .select("class", "_least", (F.col("_all") > offered).alias("more"))
    )
    lowest = Window.partitionBy("class").orderBy("user")
    first = (
        members.withColumn("_r", F.row_number().over(lowest))
        .where(F.col("_r") <= offered)
        .select(F.col("class").alias("other"), F.col("user").alias("candidate"))
    )
    in_order = Window.partitionBy("class").orderBy(F.desc("n_mutual"), "candidate")
    listed = (
        met.join(reach, "class")
        .where(F.col("n_mutual") >= F.col("_least"))
        .join(first, "other")
        .withColumn("_r", F.row_number().over(in_order))
        .where(F.col("_r") <= offered)
        .select("class", "candidate", "n_mutual", "more")
    )
    return store(listed, scratch_path(spark, "class-lists"))


def _around_hubs(
    lists: DataFrame, hubs: DataFrame, sizes: GroupSizes, n: int, offered: int, block_rows: int, hub_pairs: float
) -> DataFrame:
    """`user, candidate, n_mutual` with the n best of every user, no hub's pairs being made.

    What the hubs add to the score of two users is the number of hubs whose
    lists hold both. So users with the same hubs form a class, named by its lowest
    user, and users of one class see all others in the same order as far as hubs go. A candidate is
    either found through another vertex, or one of the first n in the order of
    the class that the user is not connected to: any n better ones would also be better in full.

    A class keeps the first `offered` users of its order. A user connected to so many of
    them that fewer than n are left, while the class has more, is computed by
    `_selected_counts` instead. Classes meet by the hubs they share, as users would, but each
    once; if every user is a class of its own, that is the work of the plain way.
    """
    spark = lists.sparkSession
    hub = hubs.select("src")
    signed = (
        lists.join(hub, "src", "left_semi")
        .groupBy(F.col("dst").alias("user"))
        .agg(F.sort_array(F.collect_set("src")).alias("hubs"))
    )
    signed = store(signed, scratch_path(spark, "hub-users"))
    classes = signed.groupBy("hubs").agg(F.min("user").alias("class"), F.count(F.lit(1)).alias("members"))
    classes = store(classes, scratch_path(spark, "hub-classes"))
    members = store(signed.join(classes, "hubs").select("user", "class"), scratch_path(spark, "class-members"))

    of_hubs = _pairs_of_group() > hub_pairs
    saved = sizes.hot.where(of_hubs).agg(F.sum(_pairs_of_group())).first()[0]
    rest = replace(sizes, hot=sizes.hot.where(~of_hubs), pairs=max(0.0, sizes.pairs - saved))
    found = drop_connected(_counts(lists.join(hub, "src", "left_anti"), rest, block_rows), lists)
    for side in ("u", "v"):
        found = found.join(signed.select(F.col("user").alias(side), F.col("hubs").alias(f"_{side}")), side, "left")
    both = F.col("_u").isNotNull() & F.col("_v").isNotNull()
    shared = F.when(both, F.size(F.array_intersect("_u", "_v"))).otherwise(0)
    found = found.select("u", "v", (F.col("n") + shared).alias("n_mutual"))
    directed = _both_ways(found, "u", "v", ("user", "candidate"), "n_mutual")

    listed = _class_lists(classes, members, offered, block_rows)
    few = is_small(listed)
    entry = F.struct((-F.col("n_mutual")).alias("less"), "candidate")
    in_order = listed.groupBy("class").agg(
        F.sort_array(F.collect_list(entry)).alias("_list"), F.first("more").alias("more")
    )
    itself = members.select("user", F.col("user").alias("candidate"))
    known = _both_ways(lists, "src", "dst", ("user", "candidate")).unionByName(itself)
    rows = listed.select("class", "candidate", "n_mutual")
    taken = (
        known.join(members, "user")
        .join(F.broadcast(rows) if few else rows, ["class", "candidate"])
        .groupBy("user")
        .agg(F.collect_set(entry).alias("_taken"))
    )
    offers = (
        members.join(F.broadcast(in_order) if few else in_order, "class")
        .join(taken, "user", "left")
        .withColumn("free", F.when(F.col("_taken").isNull(), F.col("_list")).otherwise(F.array_except("_list", "_taken")))
        .select("user", "more", F.slice("free", 1, n).alias("free"))
    )
    offers = store(offers, scratch_path(spark, "class-offers"))
    from_class = offers.select("user", F.explode("free").alias("_f")).select(
        "user", "_f.candidate", (-F.col("_f.less")).alias("n_mutual")
    )
    best = (
        directed.unionByName(from_class)
        .groupBy("user", "candidate")
        .agg(F.max("n_mutual").alias("n_mutual"))
    )
    short = offers.where(F.col("more") & (F.size("free") < n)).select("user")
    if not short.head(1):
        return best
    short = broadcast_if_small(short)
    return best.join(short, "user", "left_anti").unionByName(_selected_counts(lists, short))


def recommend_friends(
    edges: DataFrame,
    vertices: DataFrame,
    n: int = 10,
    users: Iterable[int] | None = None,
    src: str = "src",
    dst: str = "dst",
    vertex: str = "id",
    block_rows: int = BLOCK_ROWS,
    hub_pairs: float = HUB_PAIRS,
    offered: int = OFFERED,
) -> DataFrame:
    """`user, candidate, n_mutual, rank`: the n best non-friends of each vertex.

    Order: most mutual friends first, then lower id. A vertex without a
    candidate keeps one row of NULLs. With `users`, only the two-step
    neighbourhood of those users is computed. Vertices whose lists alone would
    make more than `hub_pairs` pairs are counted without making them.
    """
    owners = vertices.select(F.col(vertex).cast("bigint").alias("user")).distinct()
    lists = _adjacency(edges, src, dst)
    if users is not None:
        wanted = [int(u) for u in users]
        owners = owners.where(F.col("user").isin(wanted))
        named = edges.sparkSession.createDataFrame([(u,) for u in sorted(set(wanted))], "user bigint")
        directed = _selected_counts(lists, F.broadcast(named) if len(wanted) <= BROADCAST_ROWS else named)
    else:
        sizes = group_sizes(lists, ["src"], block_rows)
        hubs = _hubs(sizes, hub_pairs)
        if hubs is not None:
            directed = _around_hubs(lists, hubs, sizes, n, max(offered, n), block_rows, hub_pairs)
        else:
            pairs = drop_connected(_counts(lists, sizes, block_rows), lists)
            directed = _both_ways(pairs, "u", "v", ("user", "candidate"), "n").withColumnRenamed("n", "n_mutual")
    best_first = Window.partitionBy("user").orderBy(F.desc("n_mutual"), "candidate")
    best = directed.withColumn("rank", F.row_number().over(best_first).cast("bigint")).where(F.col("rank") <= n)
    return owners.join(best, "user", "left")
