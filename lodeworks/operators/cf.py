"""User-user and item-item collaborative filtering on a sparse user x item table.

A user or item whose cells add up to zero or less has no root of a degree, so it is similar to none,
itself included, and a user without one has no scores from similar users.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.operators.checkpoints import discard, scratch_path, store
from lodeworks.operators.products import Side, best_of_rows, products
from lodeworks.operators.skew import BLOCK_ROWS, broadcast_if_small, group_sizes, pairs_within, partitioned

SCORE_DIGITS = 9
# Wider than what rounding to SCORE_DIGITS can move.
TIE_WIDTH = 1e-8
# Share of a limit of similarity that the matched part of two rows must reach. More means shorter
# lists of pairs to check, and longer prefixes.
SHARE = 0.5

# Up to this many members (32 MB of doubles squared) a task holds a whole
# members x members table; DENSE_ROWS rows are worked on at a time.
MAX_DENSE = 2000
DENSE_ROWS = 1024
# Stands for the NULL user while scores are made.
NO_USER = -(2**63)


def _cells(seen: DataFrame) -> DataFrame:
    """`user, item, r` without zero cells; a cell listed more than once is the sum."""
    return seen.groupBy("user", "item").agg(F.sum(F.col("r").cast("double")).alias("r")).where(F.col("r") != 0)


def _kept_cells(seen: DataFrame) -> DataFrame:
    """The cells, stored, as products read them several times."""
    return store(_cells(seen), scratch_path(seen.sparkSession, "cells"))


def user_degree(seen: DataFrame) -> DataFrame:
    """`user, d`: row sums."""
    return _cells(seen).groupBy("user").agg(F.sum("r").alias("d"))


def item_degree(seen: DataFrame) -> DataFrame:
    """`item, d`: column sums."""
    return _cells(seen).groupBy("item").agg(F.sum("r").alias("d"))


def _few(cells: DataFrame, member: str) -> np.ndarray | None:
    """The sorted members if there are at most MAX_DENSE, else None."""
    found = cells.select(member).distinct().limit(MAX_DENSE + 1).collect()
    return np.array(sorted(r[0] for r in found)) if len(found) <= MAX_DENSE else None


def _rows_of(cells: DataFrame, shared: str, member: str, results: float) -> DataFrame:
    """`<shared>, cells ARRAY<STRUCT<m, r>>`: one row per shared id, no longer than the members."""
    entry = F.struct(F.col(member).cast("bigint").alias("m"), F.col("r"))
    return partitioned(cells, [shared], results).groupBy(shared).agg(F.collect_list(entry).alias("cells"))


def _dense(batch: pa.RecordBatch, members: np.ndarray, weighted: bool) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a batch as (rows, members), and 1 or 1 / sqrt(row sum) per row; 0 without such a root."""
    lists = batch.column(1)
    flat = lists.flatten()
    lengths = np.diff(lists.offsets.to_numpy())
    block = np.zeros((batch.num_rows, len(members)))
    at = np.searchsorted(members, flat.field(0).to_numpy(zero_copy_only=False))
    block[np.repeat(np.arange(batch.num_rows), lengths), at] = flat.field(1).to_numpy(zero_copy_only=False)
    if not weighted:
        return block, np.ones(batch.num_rows)
    degree = block.sum(axis=1)
    return block, np.divide(1, np.sqrt(np.maximum(degree, 0)), out=np.zeros(batch.num_rows), where=degree > 0)


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, DENSE_ROWS):
            yield batch.slice(start, DENSE_ROWS)


def _dense_products(rows: DataFrame, members: np.ndarray, weighted: bool) -> DataFrame:
    """`a, b, s` for a <= b, added up inside each task before the shuffle."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(members), len(members)))
        for batch in _slices(batches):
            block, weight = _dense(batch, members, weighted)
            total += block.T @ (block * weight[:, None])
        a, b = np.nonzero(np.triu(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(members[a]), pa.array(members[b]), pa.array(total[a, b])], names=["a", "b", "s"]
        )

    return (
        rows.mapInArrow(partial, "a bigint, b bigint, s double").groupBy("a", "b").agg(F.sum("s").alias("s"))
    )


def _side(cells: DataFrame, shared: str, member: str, w: Column, *extras: str) -> DataFrame:
    """`m, at, w` and `extras`, as `products` takes them."""
    return cells.select(F.col(member).cast("bigint").alias("m"), F.col(shared).alias("at"), w.cast("double").alias("w"), *extras)


def _weighted_products(cells: DataFrame, shared: str, member: str, of: DataFrame | None = None) -> DataFrame:
    """`a, b, s` for a <= b in blocks, or for every a with a row in `of` (a column `member`) and every b."""
    rated = cells.join(broadcast_if_small(cells.groupBy(shared).agg(F.sum("r").alias("d")).where("d > 0")), shared)
    left = _side(rated, shared, member, F.col("r") / F.sqrt("d"))
    if of is not None:
        left = left.join(of.select(F.col(member).cast("bigint").alias("m")), "m", "left_semi")
    return products(left, _side(rated, shared, member, F.col("r")), symmetric=of is None)


def _products(cells: DataFrame, shared: str, member: str, weighted: bool, block_rows: int) -> DataFrame:
    """`a, b, s` for a <= b: sum over shared ids of r_a * r_b, each over sqrt(sum of r) if `weighted`.

    With few members every task adds up a members x members table of its own,
    unless the pairs are fewer than such tables would have cells. With many, blocks of them meet.
    """
    members = _few(cells, member)
    if members is None and weighted:
        return _weighted_products(cells, shared, member)
    if members is None:
        sides = _side(cells, shared, member, F.col("r"))
        return products(sides, sides, symmetric=True)
    sizes = group_sizes(cells, [shared], block_rows)
    if sizes.pairs > len(members) ** 2:
        return _dense_products(_rows_of(cells, shared, member, 0), members, weighted)
    weight = F.lit(1.0)
    keys = [shared]
    if weighted:
        cells = cells.join(cells.groupBy(shared).agg(F.sum("r").alias("d")).where("d > 0"), shared)
        weight = 1 / F.sqrt("d")
        keys = [shared, "d"]
        if sizes.hot is not None:
            sizes = group_sizes(cells, keys, block_rows)
    pairs = pairs_within(cells, keys, member, sizes, carry="r", block_rows=block_rows)
    across = pairs.select("a", "b", (F.col("wa") * F.col("wb") * weight).alias("s"))
    itself = cells.select(
        F.col(member).alias("a"), F.col(member).alias("b"), (F.col("r") * F.col("r") * weight).alias("s")
    )
    return across.unionByName(itself).groupBy("a", "b").agg(F.sum("s").alias("s"))


def _mirrored(pairs: DataFrame, value: str) -> DataFrame:
    """Both orders of each pair; the diagonal once."""
    there = F.struct(F.col("i"), F.col("j"))
    back = F.struct(F.col("j").alias("i"), F.col("i").alias("j"))
    both = F.when(F.col("i") == F.col("j"), F.array(there)).otherwise(F.array(there, back))
    return pairs.select(F.explode(both).alias("p"), value).select("p.*", value)


def _cosines(sums: np.ndarray, rows: Side, columns: Side) -> tuple[np.ndarray, np.ndarray]:
    return sums != 0, sums / np.sqrt(np.multiply.outer(rows.extras["d"], columns.extras["d"]))


def _blockwise_similarity(cells: DataFrame, shared: str, member: str, of: DataFrame | None = None) -> DataFrame:
    """`i, j, sim` for i <= j, or for every i with a row in `of` (a column `member`) and every j."""
    degree = cells.groupBy(member).agg(F.sum("r").alias("d")).where("d > 0")
    sides = _side(cells.join(broadcast_if_small(degree), member), shared, member, F.col("r"), "d")
    left = sides if of is None else sides.join(of.select(F.col(member).cast("bigint").alias("m")), "m", "left_semi")
    made = products(left, sides, _cosines, extras=["d"], symmetric=of is None)
    return made.select(F.col("a").alias("i"), F.col("b").alias("j"), F.col("s").alias("sim"))


def _similarity(cells: DataFrame, shared: str, member: str, mirror: bool, block_rows: int) -> DataFrame:
    if _few(cells, member) is None:
        sim = _blockwise_similarity(cells, shared, member)
        return _mirrored(sim, "sim") if mirror else sim
    degree = cells.groupBy(F.col(member).alias("m")).agg(F.sum("r").alias("d")).where("d > 0")
    made = _products(cells, shared, member, False, block_rows)
    sim = (
        made.join(degree.select(F.col("m").alias("a"), F.col("d").alias("da")), "a")
        .join(degree.select(F.col("m").alias("b"), F.col("d").alias("db")), "b")
        .select(F.col("a").alias("i"), F.col("b").alias("j"), (F.col("s") / F.sqrt(F.col("da") * F.col("db"))).alias("sim"))
    )
    return _mirrored(sim, "sim") if mirror else sim


def item_similarity(seen: DataFrame, mirror: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`i, j, sim`: shared users over the root of both column sums, i = j included.

    With `mirror=False` each unordered pair appears once, as i <= j.
    """
    return _similarity(_kept_cells(seen), "user", "item", mirror, block_rows)


def user_similarity(seen: DataFrame, mirror: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`u, v, sim`: shared items over the root of both row sums, u = v included."""
    sim = _similarity(_kept_cells(seen), "item", "user", mirror, block_rows)
    return sim.select(F.col("i").alias("u"), F.col("j").alias("v"), "sim")


def _unit_rows(cells: DataFrame) -> DataFrame:
    """`user, item, w`: cells over the root of the row sum, so that similarity is the product of two rows."""
    degree = cells.groupBy("user").agg(F.sum("r").alias("d")).where("d > 0")
    return cells.join(degree, "user").select("user", "item", (F.col("r") / F.sqrt("d")).alias("w"))


def _prefixes(rows: DataFrame, at_least: float) -> tuple[DataFrame, float]:
    """`user, item, w, beyond, norm`: the cells by which users are matched; and the largest norm.

    A row's items stand in one order for all, rare ones first. What follows the prefix has so
    small a norm that its product with any row is below `at_least` * (1 - SHARE). `beyond` is that norm.
    """
    popular = rows.groupBy("item").agg(F.count(F.lit(1)).alias("_n"))
    from_the_end = Window.partitionBy("user").orderBy(F.desc("_n"), F.desc("item"))
    sums = (
        rows.join(broadcast_if_small(popular), "item")
        .withColumn("_rest", F.sum(F.col("w") * F.col("w")).over(from_the_end.rowsBetween(Window.unboundedPreceding, 0)))
    )
    norms = rows.groupBy("user").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    largest = norms.agg(F.max("norm")).first()[0] or 0.0
    inside = F.sqrt("_rest") * largest >= at_least * (1 - SHARE) - TIE_WIDTH
    cut = sums.groupBy("user").agg(F.sqrt(F.coalesce(F.max(F.when(~inside, F.col("_rest"))), F.lit(0.0))).alias("beyond"))
    return sums.where(inside).select("user", "item", "w").join(cut, "user").join(norms, "user"), largest


def similar_candidates(rows: DataFrame, at_least: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`a, b` (a < b): the pairs of `user, item, w` rows whose product may reach `at_least` > 0.

    Two rows whose prefixes share no item have a product below the limit: beyond the shorter
    prefix, one factor is what follows that prefix. Of the others, those are left whose product inside
    the prefixes, with the most that the rest can add (the norm of the one's rest times that of
    the other's row), reaches the limit.
    """
    prefixes, _ = _prefixes(rows, at_least)
    prefixes = store(prefixes, scratch_path(rows.sparkSession, "prefixes"))
    sides = _side(prefixes, "item", "user", F.col("w"), "beyond", "norm")

    def reach(inside: np.ndarray, one: Side, other: Side) -> tuple[np.ndarray, np.ndarray]:
        # Cheap first: no rest adds more than this.
        kept = inside >= at_least * SHARE - TIE_WIDTH
        if one.members[0] == other.members[0]:
            np.fill_diagonal(kept, False)
        i, j = np.nonzero(kept)
        rest = np.maximum(one.extras["beyond"][i] * other.extras["norm"][j], other.extras["beyond"][j] * one.extras["norm"][i])
        kept[i, j] = inside[i, j] + rest >= at_least - TIE_WIDTH
        return kept, inside

    return products(sides, sides, reach, extras=["beyond", "norm"], symmetric=True).select("a", "b")


def _product_of(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """`a, b, sim`: whole products of the given pairs of users, from the shorter row of each."""
    length = rows.groupBy("user").agg(F.count(F.lit(1)).alias("_n"))
    sided = pairs
    for side in ("a", "b"):
        sided = sided.join(length.select(F.col("user").alias(side), F.col("_n").alias(f"_{side}")), side)
    first = F.col("_a") <= F.col("_b")
    sided = sided.select("a", "b", F.when(first, F.col("a")).otherwise(F.col("b")).alias("_short"),
                         F.when(first, F.col("b")).otherwise(F.col("a")).alias("_long"))
    return (
        sided.join(rows.select(F.col("user").alias("_short"), "item", F.col("w").alias("_w")), "_short")
        .join(rows.withColumnRenamed("user", "_long"), ["_long", "item"])
        .groupBy("a", "b")
        .agg(F.round(F.sum(F.col("_w") * F.col("w")), SCORE_DIGITS).alias("sim"))
    )


def similar_users(seen: DataFrame, at_least: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`u, v, sim` for u < v: the pairs whose similarity, rounded to SCORE_DIGITS, is `at_least` (> 0) or more.

    Pairs that cannot reach it are never made, see `similar_candidates`. For items, name the columns the
    other way round.
    """
    if at_least <= 0:
        raise ValueError("at_least must be above 0; user_similarity gives all pairs")
    spark = seen.sparkSession
    rows = store(_unit_rows(_cells(seen)), scratch_path(spark, "unit-rows"))
    found = _product_of(similar_candidates(rows, at_least, block_rows), rows)
    return found.where(F.col("sim") >= at_least).select(F.col("a").alias("u"), F.col("b").alias("v"), "sim")


def similar_users_top_n(
    seen: DataFrame, n: int = 5, start: float = 0.5, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """`user, other, sim, rank`: the n users most similar to each, of those above 0; ties go to the lower id.

    Whoever has n others of `start` or more is served from those pairs. The rest are compared with all that they
    share an item with. `start` decides about time, not about rows.
    """
    spark = seen.sparkSession
    cells = _kept_cells(seen)
    near = similar_users(cells, start, block_rows).withColumnRenamed("u", "i").withColumnRenamed("v", "j")
    near = store(_mirrored(near, "sim"), scratch_path(spark, "near-users"))
    rows = store(_unit_rows(cells), scratch_path(spark, "unit-rows"))
    served = near.groupBy("i").count().where(F.col("count") >= n).select(F.col("i").alias("user"))
    mine = rows.join(broadcast_if_small(served), "user", "left_anti")

    def best(sums: np.ndarray, one: Side, other: Side) -> tuple[np.ndarray, np.ndarray]:
        kept = (sums > 0) & (one.members[:, None] != other.members)
        return best_of_rows(sums, kept, n, TIE_WIDTH), sums

    rest = (
        products(_side(mine, "item", "user", F.col("w")), _side(rows, "item", "user", F.col("w")), best)
        .select(F.col("a").alias("i"), F.col("b").alias("j"), F.round("s", SCORE_DIGITS).alias("sim"))
        .where("sim > 0")
    )
    found = near.join(served, F.col("i") == F.col("user"), "left_semi").unionByName(rest)
    best_first = Window.partitionBy("i").orderBy(F.desc("sim"), "j")
    ranked = found.withColumn("rank", F.row_number().over(best_first).cast("bigint")).where(F.col("rank") <= n)
    return ranked.select(F.col("i").alias("user"), F.col("j").alias("other"), "sim", "rank")


def _dense_scores(
    rows: DataFrame, members: np.ndarray, table: np.ndarray, weighted: bool, top: int | None, unseen: bool = False
) -> DataFrame:
    """`user, item, score`: each row times the items x items table, inside the task."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            block, weight = _dense(batch, members, weighted)
            scores = (block * weight[:, None]) @ table
            kept = scores != 0
            if unseen:
                kept &= block == 0
            if top is not None:
                # Near ties stay, so that rounding later decides about them.
                kept = best_of_rows(scores, kept, top, TIE_WIDTH)
            row, item = np.nonzero(kept)
            users = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(users[row]), pa.array(members[item]), pa.array(scores[row, item])],
                names=["user", "item", "score"],
            )

    return rows.mapInArrow(score, "user bigint, item bigint, score double")


def _times_items(
    cells: DataFrame, weights: DataFrame, weighted: bool, users: Iterable[int] | None, top: int | None, unseen: bool = False
) -> DataFrame:
    """`user, item, score`: rows of the cell table times `i, j, w`; zero scores are left out.

    Up to MAX_DENSE items the table goes to every task. Beyond that blocks of users meet blocks of items.
    """
    members = _few(cells, "item")
    cells = cells if users is None else cells.where(F.col("user").isin([int(u) for u in users]))
    if members is not None:
        found = weights.select("i", "j", "w").toArrow()
        table = np.zeros((len(members), len(members)))
        at = [np.searchsorted(members, found.column(c).to_numpy()) for c in ("i", "j")]
        table[at[0], at[1]] = found.column("w").to_numpy()
        n_users = cells.select("user").distinct().count()
        rows = _rows_of(cells, "user", "item", float(n_users) * len(members))
        return _dense_scores(rows.withColumn("user", F.col("user").cast("bigint")), members, table, weighted, top, unseen)
    share = F.col("r")
    if weighted:
        cells = cells.join(cells.groupBy("user").agg(F.sum("r").alias("d")).where("d > 0"), "user")
        share = F.col("r") / F.sqrt("d")
    cells = cells.withColumn("user", F.coalesce(F.col("user").cast("bigint"), F.lit(NO_USER)))

    def best(scores: np.ndarray, rows: Side, items: Side) -> tuple[np.ndarray, np.ndarray]:
        kept = scores != 0
        if unseen:
            at = np.minimum(np.searchsorted(items.members, rows.at), len(items.members) - 1)
            own = items.members[at] == rows.at
            kept[rows.place[own], at[own]] = False
        return kept if top is None else best_of_rows(scores, kept, top, TIE_WIDTH), scores

    path = scratch_path(cells.sparkSession, "weights")
    weights = store(weights.select(F.col("j").alias("m"), F.col("i").alias("at"), "w"), path)
    made = products(_side(cells, "item", "user", share), weights, best)
    discard(cells.sparkSession, path)
    return made.select(F.expr(f"nullif(a, {NO_USER})").alias("user"), F.col("b").alias("item"), F.col("s").alias("score"))


def _items_of(cells: DataFrame, users: Iterable[int]) -> DataFrame:
    return cells.where(F.col("user").isin([int(u) for u in users])).select("item").distinct()


def cf_scores_item(
    seen: DataFrame, users: Iterable[int] | None = None, top: int | None = None, block_rows: int = BLOCK_ROWS,
    unseen: bool = False,
) -> DataFrame:
    """`user, item, score`: seen items weighted by item similarity.

    Give `top` if only `cf_top_n` with at most that n and no item filter follows;
    then a task may leave out what cannot be among a user's `top` best. With `unseen`, a user's own items are left out.
    Only the similarities of items that `users` have seen are made if many items are known.
    """
    cells = _kept_cells(seen)
    users = users if users is None else list(users)
    if users is not None and _few(cells, "item") is None:
        similar = _blockwise_similarity(cells, "user", "item", _items_of(cells, users))
    else:
        similar = _similarity(cells, "user", "item", True, block_rows)
    return _times_items(cells, similar.withColumnRenamed("sim", "w"), False, users, top, unseen)


def cf_scores_user(
    seen: DataFrame, users: Iterable[int] | None = None, top: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """`user, item, score`: similar users' items, weighted by user similarity.

    `top` is as in `cf_scores_item`. The product (users x users)(users x items) is grouped the other way, so the
    table in the middle is items x items and never users x users.
    """
    cells = _kept_cells(seen)
    users = users if users is None else list(users)
    if users is not None and _few(cells, "item") is None:
        middle = _weighted_products(cells, "user", "item", _items_of(cells, users))
        return _times_items(cells, middle.select(F.col("a").alias("i"), F.col("b").alias("j"), F.col("s").alias("w")), True, users, top)
    middle = _products(cells, "user", "item", True, block_rows).select(
        F.col("a").alias("i"), F.col("b").alias("j"), F.col("s").alias("w")
    )
    return _times_items(cells, _mirrored(middle, "w"), True, users, top)


def cf_top_n(
    scores: DataFrame,
    n: int = 5,
    users: Iterable[int] | None = None,
    item_filter: Column | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """`user, item, score, rank`: the n best items of each user; ties go to the lower item.

    Scores are rounded before ranking. `item_filter` limits the items, and items
    in `seen` are left out when it is given.
    """
    kept = scores if users is None else scores.where(F.col("user").isin([int(u) for u in users]))
    if item_filter is not None:
        kept = kept.where(item_filter)
    if seen is not None:
        kept = kept.join(_cells(seen).select("user", "item"), ["user", "item"], "left_anti")
    kept = kept.withColumn("score", F.round("score", SCORE_DIGITS))
    best_first = Window.partitionBy("user").orderBy(F.desc("score"), "item")
    return kept.withColumn("rank", F.row_number().over(best_first).cast("bigint")).where(F.col("rank") <= n)
