"""Frequent itemsets by level-wise pruning, and association rules."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.operators.checkpoints import scratch_path, store
from lodeworks.operators.skew import BLOCK_ROWS, GroupSizes, broadcast_if_small, group_sizes, is_small, pairs_within

COUNT_MODES = ("basket", "occurrence")


def _entries(baskets: DataFrame, basket: str, item: str, count: str) -> DataFrame:
    """`basket_id, item, c`: each item of a basket once, c = times it counts."""
    if count not in COUNT_MODES:
        raise ValueError(f"count must be one of {COUNT_MODES}")
    times = F.count(F.lit(1)) if count == "occurrence" else F.lit(1).cast("bigint")
    return baskets.groupBy(F.col(basket).alias("basket_id"), F.col(item).alias("item")).agg(times.alias("c"))


def frequent_items(
    baskets: DataFrame,
    min_support: int,
    count: str = "basket",
    basket: str = "basket_id",
    item: str = "item",
) -> DataFrame:
    """`a, n`: items in at least `min_support` baskets (or occurrences)."""
    if count == "occurrence":
        single = baskets.select(F.col(item).alias("a"))
    else:
        single = _entries(baskets, basket, item, count).select(F.col("item").alias("a"))
    return single.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_support)


def _codes(items: DataFrame) -> tuple[DataFrame, bool]:
    """`item, code`, and whether they are few: short codes in item order, so that pairs shuffle as integers.

    The codes are numbered in one task and broadcast, which the row limit of
    `is_small` bounds. A larger item list stands for itself.
    """
    known = items.select(F.col("a").alias("item")).persist()
    if is_small(known):
        return F.broadcast(known.withColumn("code", F.row_number().over(Window.orderBy("item")))), True
    return known.withColumn("code", F.col("item")), False


def _kept(baskets: DataFrame, codes: DataFrame, basket: str, item: str) -> DataFrame:
    """`basket_id, code` of the frequent items, repeats included."""
    rows = baskets.select(F.col(basket).alias("basket_id"), F.col(item).alias("item"))
    return rows.join(codes, "item").select("basket_id", "code")


def _later(column: str, at: str) -> Column:
    """The part of an array behind position `at`."""
    return F.slice(column, F.col(at) + 2, F.size(column))


def _listed(kept: DataFrame, few: bool, count: str, block_rows: int) -> DataFrame | None:
    """`codes`, with `times` if occurrences count: each basket's items in order, gathered by one shuffle and stored.

    From such a row its pairs and larger sets are made without another shuffle. None if the items
    are many or a basket holds more than `block_rows` of them: the sets of such a basket are for many tasks.
    """
    if not few:
        return None
    if count == "basket":
        lists = kept.repartition("basket_id").groupBy("basket_id").agg(F.sort_array(F.collect_set("code")).alias("codes"))
        lists = lists.select("codes")
    else:
        entries = _entries(kept, "basket_id", "code", count).groupBy("basket_id").agg(
            F.sort_array(F.collect_list(F.struct("item", "c"))).alias("e")
        )
        lists = entries.select(F.col("e.item").alias("codes"), F.col("e.c").alias("times"))
    lists = store(lists, scratch_path(kept.sparkSession, "baskets"))
    longest = lists.agg(F.max(F.size("codes"))).first()[0] or 0
    return lists if longest <= block_rows else None


def _listed_pairs(lists: DataFrame, min_support: int, count: str) -> DataFrame:
    """`a, b, n` as of `_coded_pairs`."""
    if count == "basket":
        first = lists.select("codes", F.posexplode("codes").alias("_p", "a"))
        totals = first.select("a", F.explode(_later("codes", "_p")).alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    else:
        first = lists.select("codes", "times", F.posexplode("codes").alias("_p", "a"))
        first = first.select("a", F.col("times")[F.col("_p")].alias("_c"), _later("codes", "_p").alias("_codes"), _later("times", "_p").alias("_times"))
        across = first.select("a", "_c", "_times", F.posexplode("_codes").alias("_q", "b")).select(
            "a", "b", (F.col("_c") * F.col("_times")[F.col("_q")]).alias("k")
        )
        itself = first.where(F.col("_c") > 1).select("a", F.col("a").alias("b"), F.expr("_c * (_c - 1) div 2").alias("k"))
        totals = across.unionByName(itself).groupBy("a", "b").agg(F.sum("k").alias("n"))
    return totals.where(F.col("n") >= min_support)


def _listed_triples(lists: DataFrame, known: DataFrame) -> DataFrame:
    """`a, b, c`, once for each basket: the triples whose three pairs are known."""
    first = lists.select("codes", F.posexplode("codes").alias("_p", "a")).select("a", _later("codes", "_p").alias("_rest"))
    second = first.select("a", "_rest", F.posexplode("_rest").alias("_q", "b")).join(known, ["a", "b"], "left_semi")
    grown = second.select("a", "b", F.explode(_later("_rest", "_q")).alias("c"))
    for other in ("a", "b"):
        grown = grown.join(known.select(F.col("a").alias(other), F.col("b").alias("c")), [other, "c"], "left_semi")
    return grown


def _recode(sets: DataFrame, codes: DataFrame, columns: list[str], source: str, target: str) -> DataFrame:
    """The same rows with `columns` changed from `source` to `target` (item, code)."""
    for column in columns:
        names = codes.select(F.col(source).alias(column), F.col(target).alias("_new"))
        sets = sets.join(names, column).drop(column).withColumnRenamed("_new", column)
    return sets.select(*columns, *[c for c in sets.columns if c not in columns])


def _coded_pairs(
    kept: DataFrame, sizes: GroupSizes, min_support: int, count: str, block_rows: int
) -> DataFrame:
    if count == "basket":
        found = pairs_within(kept, ["basket_id"], "code", sizes, block_rows=block_rows, repeats=True)
        totals = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    else:
        # x copies of a and y copies of b make x*y pairs; c copies of one item
        # make c*(c-1)/2 pairs with itself.
        counted = _entries(kept, "basket_id", "code", count)
        found = pairs_within(counted, ["basket_id"], "item", sizes, carry="c", block_rows=block_rows)
        across = found.select("a", "b", (F.col("wa") * F.col("wb")).alias("k"))
        itself = counted.where(F.col("c") > 1).select(
            F.col("item").alias("a"),
            F.col("item").alias("b"),
            F.expr("c * (c - 1) div 2").alias("k"),
        )
        totals = across.unionByName(itself).groupBy("a", "b").agg(F.sum("k").alias("n"))
    return totals.where(F.col("n") >= min_support)


def frequent_pairs(
    baskets: DataFrame,
    min_support: int,
    count: str = "basket",
    basket: str = "basket_id",
    item: str = "item",
    items: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`a, b, n`: pairs of frequent items with enough support.

    Counted by occurrence, repeated items multiply and pair with themselves.
    Pass `items` to reuse a result of `frequent_items` with the same settings.
    """
    if items is None:
        items = frequent_items(baskets, min_support, count, basket, item)
    codes, few = _codes(items)
    kept = _kept(baskets, codes, basket, item)
    lists = _listed(kept, few, count, block_rows)
    if lists is not None:
        pairs = _listed_pairs(lists, min_support, count)
    else:
        pairs = _coded_pairs(kept, group_sizes(kept, ["basket_id"], block_rows), min_support, count, block_rows)
    return _recode(pairs, codes, ["a", "b"], "code", "item")


def _stem_sizes(stems: DataFrame, stem: list[str], baskets: GroupSizes, block_rows: int) -> GroupSizes:
    """Sizes of the (basket, stem) groups. Hot ones lie in hot baskets, so often there can be none."""
    if baskets.hot is None:
        return baskets
    within = stems.join(baskets.hot.select("basket_id"), "basket_id", "left_semi")
    return replace(group_sizes(within, ["basket_id", *stem], block_rows), pairs=baskets.pairs)


def frequent_triples(
    baskets: DataFrame,
    min_support: int,
    count: str = "basket",
    basket: str = "basket_id",
    item: str = "item",
    items: DataFrame | None = None,
    pairs: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`a, b, c, n`: triples whose three pairs are frequent, with enough support.

    Triples count baskets in both modes; `count` sets which pairs are frequent.
    Pass `items` and `pairs` to reuse results with the same settings.
    """
    if items is None:
        items = frequent_items(baskets, min_support, count, basket, item)
    codes, few = _codes(items)
    kept = _kept(baskets, codes, basket, item)
    lists = _listed(kept, few, count if pairs is None else "basket", block_rows)
    sizes = group_sizes(kept, ["basket_id"], block_rows) if lists is None else None
    if pairs is not None:
        known = _recode(pairs, codes, ["a", "b"], "item", "code")
    elif lists is not None:
        known = _listed_pairs(lists, min_support, count)
    else:
        known = _coded_pairs(kept, sizes, min_support, count, block_rows)
    known = broadcast_if_small(known.select("a", "b"))
    if lists is not None:
        totals = _listed_triples(lists, known).groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n"))
        return _recode(totals.where(F.col("n") >= min_support), codes, ["a", "b", "c"], "code", "item")
    held = pairs_within(kept, ["basket_id"], "code", sizes, block_rows=block_rows, repeats=True).join(
        known, ["a", "b"], "left_semi"
    )
    # Two pairs with the same first item make a triple if the third is frequent.
    stems = held.withColumnRenamed("a", "first")
    grown = pairs_within(
        stems, ["basket_id", "first"], "b", _stem_sizes(stems, ["first"], sizes, block_rows), block_rows=block_rows
    ).join(known, ["a", "b"], "left_semi")
    totals = grown.groupBy(
        F.col("first").alias("a"), F.col("a").alias("b"), F.col("b").alias("c")
    ).agg(F.count(F.lit(1)).alias("n"))
    return _recode(totals.where(F.col("n") >= min_support), codes, ["a", "b", "c"], "code", "item")


def frequent_itemsets(
    baskets: DataFrame,
    min_support: int,
    max_k: int = 3,
    basket: str = "basket_id",
    item: str = "item",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`items, n`: all itemsets of 1..max_k items held by enough baskets.

    Level k joins two frequent (k-1)-sets of a basket that differ in their last
    item and keeps the sets whose (k-1)-subsets are all frequent.
    """
    singles = frequent_items(baskets, min_support, "basket", basket, item)
    codes, few = _codes(singles)
    found = singles.select(F.array("a").alias("items"), "n")
    kept = _kept(baskets, codes, basket, item)
    lists = _listed(kept, few, "basket", block_rows) if max_k > 1 else None
    if lists is None:
        held = kept.withColumnRenamed("code", "i1")
        sizes = group_sizes(held, ["basket_id"], block_rows)
    else:
        held = lists.select("codes", F.posexplode("codes").alias("_p", "i1")).select("i1", _later("codes", "_p").alias("rest"))
    level: DataFrame | None = None
    for k in range(2, max_k + 1):
        stem = [f"i{j}" for j in range(1, k - 1)]
        names = [f"i{j}" for j in range(1, k + 1)]
        if lists is None:
            here = sizes if k == 2 else _stem_sizes(held, stem, sizes, block_rows)
            grown = pairs_within(
                held, ["basket_id", *stem], f"i{k - 1}", here, block_rows=block_rows, repeats=k == 2
            ).select("basket_id", *stem, F.col("a").alias(f"i{k - 1}"), F.col("b").alias(f"i{k}"))
        else:
            # A set and what stands behind it in its basket grow by one item of the rest.
            grown = held.select(*names[:-1], "rest", F.posexplode("rest").alias("_p", names[-1])).select(
                *names, _later("rest", "_p").alias("rest")
            )
        # One parent lacks the last item, and with a shuffle another the one before; check the others.
        for gone in range(k - 2 if lists is None or k == 2 else k - 1):
            subset = names[:gone] + names[gone + 1 :]
            known = level.select(*[F.col(f"i{j + 1}").alias(name) for j, name in enumerate(subset)])
            grown = grown.join(known, subset, "left_semi")
        level = broadcast_if_small(
            grown.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_support)
        )
        held = grown.join(level.select(*names), names, "left_semi")
        named = _recode(level, codes, names, "code", "item")
        found = found.unionByName(named.select(F.array(*names).alias("items"), "n"))
    return found


def _conditional(lists: DataFrame, pairs: DataFrame) -> DataFrame:
    """`items`: for each item of a basket that has frequent partners behind it, those partners, marked with the item.

    A set without its first item is in as many of these rows as the set is in baskets. Items that
    make no frequent pair are gone, so that most rows are alike.
    """
    partners = pairs.groupBy("a").agg(F.collect_list("b").alias("_partners"))
    partners = F.broadcast(partners) if is_small(pairs) else partners
    first = lists.select("codes", F.posexplode("codes").alias("_p", "a")).select("a", _later("codes", "_p").alias("_rest"))
    met = first.join(partners, "a").select("a", F.array_intersect("_rest", "_partners").alias("_met"))
    return met.where(F.size("_met") > 0).select(
        F.transform("_met", lambda b: F.shiftleft(F.col("a").cast("bigint"), 32) + b).alias("items")
    )


def frequent_itemsets_fp(
    baskets: DataFrame,
    min_support: int,
    max_k: int = 3,
    basket: str = "basket_id",
    item: str = "item",
) -> DataFrame:
    """The same `items, n` from the built-in FPGrowth.

    FPGrowth spends its time on projecting trees of baskets that differ in nearly all their items, so it gets the
    baskets as `_conditional` cuts them, by rare items first: its trees hold a path per set of partners. Items without
    support go before, so a basket's array is never longer than the list of frequent items, which FPGrowth
    holds in the driver. It takes a share of its rows, so the count is turned into one and tested again afterwards.
    """
    spark = baskets.sparkSession
    singles = frequent_items(baskets, min_support, "basket", basket, item).where(F.col("a").isNotNull())
    codes = broadcast_if_small(
        singles.select(F.col("a").alias("item"), "n", F.row_number().over(Window.orderBy("n", "a")).alias("code"))
    )
    found = codes.select(F.array("item").alias("items"), "n").where(F.size("items") <= max_k)
    if max_k < 2:
        return found
    kept = _kept(baskets, codes.select("item", "code"), basket, item)
    lists = kept.groupBy("basket_id").agg(F.sort_array(F.collect_set("code")).alias("codes")).select("codes")
    lists = store(lists, scratch_path(spark, "baskets"))
    pairs = store(_listed_pairs(lists, min_support, "basket"), scratch_path(spark, "pairs"))
    rows = _conditional(lists, pairs).persist()
    try:
        size = rows.count()
        share = min(1.0, max(0.0, (min_support - 0.5) / size)) if size else 1.0
        model = FPGrowth(itemsCol="items", minSupport=share).fit(rows)
        grown = model.freqItemsets.where((F.size("items") < max_k) & (F.col("freq") >= min_support))
        grown = store(grown, scratch_path(spark, "grown"))
    finally:
        rows.unpersist()
    first = F.shiftright(F.col("items")[0], 32)
    members = F.concat(F.array(first), F.transform("items", lambda x: x.bitwiseAND(0xFFFFFFFF)))
    named = grown.select("items", "freq", F.explode(members).alias("code")).join(codes.select("item", "code"), "code")
    return found.unionByName(
        named.groupBy("items", "freq").agg(F.array_sort(F.collect_list("item")).alias("_set")).select(
            F.col("_set").alias("items"), F.col("freq").alias("n")
        )
    )


def rules_1to1(items: DataFrame, pairs: DataFrame) -> DataFrame:
    """`x, y, support, confidence` of x => y, both ways round for each pair."""
    both = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("x"), F.col("b").alias("y")),
                F.struct(F.col("b").alias("x"), F.col("a").alias("y")),
            )
        ).alias("r"),
        F.col("n").alias("support"),
    ).select("r.*", "support")
    base = items.select(F.col("a").alias("x"), F.col("n").alias("n_x"))
    return both.join(base, "x").select("x", "y", "support", (F.col("support") / F.col("n_x")).alias("confidence"))


def rules_2to1(pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """`x, y, z, support, confidence` of (x, y) => z, three per triple."""

    def rule(x: str, y: str, z: str) -> Column:
        return F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.col(z).alias("z"))

    three = triples.select(
        F.explode(F.array(rule("a", "b", "c"), rule("a", "c", "b"), rule("b", "c", "a"))).alias("r"),
        F.col("n").alias("support"),
    ).select("r.*", "support")
    base = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("n").alias("n_xy"))
    return three.join(base, ["x", "y"]).select(
        "x", "y", "z", "support", (F.col("support") / F.col("n_xy")).alias("confidence")
    )


def top_rules(rules: DataFrame, n: int = 5) -> DataFrame:
    """The n first rules: highest confidence, then the rule itself ascending."""
    sides = [c for c in ("x", "y", "z") if c in rules.columns]
    return rules.orderBy(F.desc("confidence"), *sides).limit(n)
