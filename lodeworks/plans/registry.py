"""The registered queries: every operator on inputs derived from the shared tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.operators import basket, cf, cluster, factor, graph, linalg, neighbors
from lodeworks.operators.skew import broadcast_if_small
from lodeworks.plans import inputs, settings
from lodeworks.sources.writers import friend_lists

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.round(c, settings.DIGITS) for c in columns})


# Friend recommendation

def mutual_friend_counts(spark: SparkSession, sf: str) -> DataFrame:
    return graph.mutual_friend_counts(inputs.friend_edges(spark, sf))


def non_friend_pairs(spark: SparkSession, sf: str) -> DataFrame:
    edges = inputs.friend_edges(spark, sf)
    return graph.drop_connected(graph.mutual_friend_counts(edges), edges)


def recommend_friends(spark: SparkSession, sf: str) -> DataFrame:
    found = graph.recommend_friends(
        inputs.friend_edges(spark, sf), inputs.people(spark, sf), settings.TOP_FRIENDS
    )
    return friend_lists(found)


def recommend_friends_hubs(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows, with limits so low that many vertices are hubs."""
    found = graph.recommend_friends(
        inputs.friend_edges(spark, sf), inputs.people(spark, sf), settings.TOP_FRIENDS,
        block_rows=settings.LOW_BLOCK_ROWS, hub_pairs=settings.LOW_HUB_PAIRS,
    )
    return friend_lists(found)


def recommend_friends_selected(spark: SparkSession, sf: str) -> DataFrame:
    found = graph.recommend_friends(
        inputs.friend_edges(spark, sf), inputs.people(spark, sf), settings.TOP_FRIENDS, settings.REPORT_USERS
    )
    return friend_lists(found)


# Frequent itemsets and rules

def _market(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    rows = inputs.baskets(spark, sf)
    orders = inputs.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("basket_id"))
    return rows, inputs.support_of(orders, settings.SUPPORT_SHARE)


def frequent_items(spark: SparkSession, sf: str) -> DataFrame:
    return basket.frequent_items(*_market(spark, sf))


def frequent_items_occurrence(spark: SparkSession, sf: str) -> DataFrame:
    return basket.frequent_items(*_market(spark, sf), count="occurrence")


def frequent_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return basket.frequent_pairs(*_market(spark, sf))


def frequent_pairs_occurrence(spark: SparkSession, sf: str) -> DataFrame:
    return basket.frequent_pairs(*_market(spark, sf), count="occurrence")


def frequent_triples(spark: SparkSession, sf: str) -> DataFrame:
    return basket.frequent_triples(*_market(spark, sf))


def frequent_triples_occurrence(spark: SparkSession, sf: str) -> DataFrame:
    return basket.frequent_triples(*_market(spark, sf), count="occurrence")


def _joined(itemsets: DataFrame) -> DataFrame:
    return itemsets.select(F.concat_ws(",", "items").alias("items"), "n")


def frequent_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(basket.frequent_itemsets(*_market(spark, sf), max_k=3))


def frequent_itemsets_fp(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(basket.frequent_itemsets_fp(*_market(spark, sf), max_k=3))


def _rules_1to1(spark: SparkSession, sf: str, count: str = "basket") -> DataFrame:
    rows, support = _market(spark, sf)
    items = broadcast_if_small(basket.frequent_items(rows, support, count))
    return basket.rules_1to1(items, basket.frequent_pairs(rows, support, count, items=items))


def _rules_2to1(spark: SparkSession, sf: str) -> DataFrame:
    rows, support = _market(spark, sf)
    items = broadcast_if_small(basket.frequent_items(rows, support))
    pairs = broadcast_if_small(basket.frequent_pairs(rows, support, items=items))
    return basket.rules_2to1(pairs, basket.frequent_triples(rows, support, items=items, pairs=pairs))


def rules_1to1(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_rules_1to1(spark, sf), "confidence")


def rules_2to1(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_rules_2to1(spark, sf), "confidence")


def top_rules_1to1(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(basket.top_rules(_rules_1to1(spark, sf), settings.TOP_RULES), "confidence")


def top_rules_2to1(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(basket.top_rules(_rules_2to1(spark, sf), settings.TOP_RULES), "confidence")


# Nearest neighbours

def lsh_signatures(spark: SparkSession, sf: str) -> DataFrame:
    return neighbors.lsh_signatures(inputs.vectors(spark, sf), settings.FAMILY)


def lsh_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return neighbors.lsh_candidates(lsh_signatures(spark, sf), settings.QUERY_IDS)


def lsh_knn(spark: SparkSession, sf: str) -> DataFrame:
    found = neighbors.lsh_knn(
        inputs.vectors(spark, sf), settings.FAMILY, settings.QUERY_IDS, settings.NEIGHBORS
    )
    return _rounded(found, "dist")


def distances(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(neighbors.distances(inputs.vectors(spark, sf), settings.QUERY_IDS), "dist")


def pair_distances(spark: SparkSession, sf: str) -> DataFrame:
    pairs = lsh_candidates(spark, sf)
    return _rounded(neighbors.pair_distances(pairs, inputs.vectors(spark, sf), "l2"), "dist")


def exact_knn(spark: SparkSession, sf: str) -> DataFrame:
    found = neighbors.exact_knn(inputs.vectors(spark, sf), settings.QUERY_IDS, settings.NEIGHBORS)
    return _rounded(found, "dist")


def ann_error(spark: SparkSession, sf: str) -> DataFrame:
    vectors = inputs.vectors(spark, sf)
    lsh = neighbors.lsh_knn(vectors, settings.FAMILY, settings.QUERY_IDS, settings.NEIGHBORS)
    exact = neighbors.exact_knn(vectors, settings.QUERY_IDS, settings.NEIGHBORS)
    return _rounded(neighbors.ann_error(lsh, exact), "error")


def ann_sweep(spark: SparkSession, sf: str) -> DataFrame:
    swept = neighbors.ann_sweep(
        inputs.vectors(spark, sf), settings.SWEEP, settings.QUERY_IDS, settings.NEIGHBORS
    )
    return _rounded(swept, "error")


# Linear algebra

def gram_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(linalg.gram_matrix(inputs.vectors(spark, sf)), "g")


def eigen_sym(spark: SparkSession, sf: str) -> DataFrame:
    return linalg.eigen_sym(inputs.vectors(spark, sf))


def svd(spark: SparkSession, sf: str) -> DataFrame:
    return linalg.svd(inputs.vectors(spark, sf))


def svd_project(spark: SparkSession, sf: str) -> DataFrame:
    vectors = inputs.vectors(spark, sf)
    return linalg.svd_project(vectors, linalg.svd(vectors))


def eigen_reconstruction(spark: SparkSession, sf: str) -> DataFrame:
    """The cells of the Gram matrix, put together again from its eigen-pairs."""
    pairs = linalg.eigen_sym(inputs.vectors(spark, sf))
    one = pairs.select("rank", "eigenvalue", F.posexplode("vector").alias("i", "x"))
    other = pairs.select("rank", F.posexplode("vector").alias("j", "y"))
    cells = one.join(other, "rank").groupBy("i", "j").agg(F.sum(F.col("eigenvalue") * F.col("x") * F.col("y")).alias("g"))
    return _rounded(cells, "g")


def svd_reconstruction(spark: SparkSession, sf: str) -> DataFrame:
    """The cells of the vectors, put together again from their projection, singular values and directions."""
    vectors = inputs.vectors(spark, sf)
    parts = linalg.svd(vectors)
    u = linalg.svd_project(vectors, parts).select("id", F.posexplode("u").alias("r", "u"))
    directions = parts.select((F.col("rank") - 1).alias("r"), "sigma", F.posexplode("v").alias("dim", "x"))
    cells = u.join(directions, "r").groupBy("id", "dim").agg(F.sum(F.col("u") * F.col("sigma") * F.col("x")).alias("x"))
    return _rounded(cells, "x")


def svd_leading(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the few leading directions, found without the others, are fixed by the Gram matrix."""
    vectors = inputs.vectors(spark, sf)
    parts = linalg.svd(vectors, settings.LEADING)
    cells = parts.select("rank", "sigma", F.posexplode("v").alias("j", "x"))
    turned = linalg.gram_matrix(vectors).join(cells, "j").groupBy("rank", "sigma", "i").agg(F.sum(F.col("g") * F.col("x")).alias("gx"))
    own = cells.select("rank", F.col("j").alias("i"), "x")
    rest = F.col("gx") - F.col("sigma") * F.col("sigma") * F.col("x")
    left = turned.join(own, ["rank", "i"]).groupBy("rank", "sigma").agg(F.sqrt(F.sum(rest * rest)).alias("rest"))
    return left.select("rank", (F.col("rest") <= 1e-3 * F.col("sigma") * F.col("sigma")).alias("fixed"))


# Clustering

def first_centroids(spark: SparkSession, sf: str, init: str) -> DataFrame:
    """`cid, c`: the named vectors, numbered in the order they are named."""
    ids = settings.FIRST_CENTROIDS[init]
    return inputs.vectors(spark, sf).where(F.col("id").isin(ids)).select(
        (F.array_position(F.array(*[F.lit(i).cast("bigint") for i in ids]), F.col("id")) - 1).cast("int").alias("cid"),
        F.col("v").alias("c"),
    )


def _assigned(spark: SparkSession, sf: str, metric: str) -> DataFrame:
    return cluster.kmeans_assign(inputs.vectors(spark, sf), first_centroids(spark, sf, "random"), metric)


def kmeans_assign_l1(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_assigned(spark, sf, "l1").drop("v"), "cost")


def kmeans_assign_l2(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_assigned(spark, sf, "l2").drop("v"), "cost")


def kmeans_update(spark: SparkSession, sf: str) -> DataFrame:
    clusters = cluster.kmeans_update(_assigned(spark, sf, "l2"))
    cells = clusters.select("cid", "n", "cost", F.posexplode("c").alias("dim", "x"))
    return _rounded(cells, "cost", "x")


def _trace(metric: str, init: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        first = {init: first_centroids(spark, sf, init)}
        _, trace = cluster.kmeans_fit(inputs.vectors(spark, sf), first, [metric], settings.KMEANS_ITERS)
        return _rounded(trace, "cost", "pct_of_first")

    return query


def kmeans_cost_drop(spark: SparkSession, sf: str) -> DataFrame:
    """What all four runs have saved of the first cost, in one pass over the vectors per iteration."""
    first = {init: first_centroids(spark, sf, init) for init in settings.FIRST_CENTROIDS}
    _, trace = cluster.kmeans_fit(inputs.vectors(spark, sf), first, iters=settings.DROP_AFTER)
    return _rounded(cluster.cost_drop(trace, settings.DROP_AFTER), "pct_of_first", "pct_dropped")


# Latent factors

def rating_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return factor.rating_ranges(inputs.ratings(spark, sf))


def _first_factors(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    users = ratings.select(F.col("user").alias("id")).distinct()
    items = ratings.select(F.col("item").alias("id")).distinct()
    top = settings.TOP_RATING
    return factor.mf_init(users, settings.FACTORS, top, "p"), factor.mf_init(items, settings.FACTORS, top, "q")


def mf_init(spark: SparkSession, sf: str) -> DataFrame:
    P, Q = _first_factors(inputs.ratings(spark, sf))
    both = P.select(F.lit("p").alias("side"), "*").unionByName(Q.select(F.lit("q").alias("side"), "*"))
    return _rounded(both.select("side", "id", F.posexplode("f").alias("j", "x")), "x")


def mf_objective(spark: SparkSession, sf: str) -> DataFrame:
    ratings = inputs.ratings(spark, sf)
    return _rounded(factor.mf_objective(ratings, *_first_factors(ratings), settings.REG), "objective")


def mf_fit(spark: SparkSession, sf: str) -> DataFrame:
    """All epochs; the number of blocks follows from the number of ratings."""
    return factor.mf_fit(inputs.ratings(spark, sf), epochs=settings.EPOCHS, lr=settings.LEARNING_RATES[0])[2]


def mf_fit_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """A few epochs in blocks and parts of blocks."""
    ratings = inputs.ratings(spark, sf)
    trace = factor.mf_fit(ratings, epochs=settings.BLOCK_EPOCHS, lr=settings.LEARNING_RATES[0], blocks=settings.MF_BLOCKS)[2]
    return _descends(ratings, trace)


def mf_lr_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return factor.mf_lr_sweep(inputs.ratings(spark, sf), settings.LEARNING_RATES, epochs=settings.EPOCHS)


def _start(ratings: DataFrame) -> float:
    """The objective of the first factors."""
    return round(factor.mf_objective(ratings, *_first_factors(ratings), settings.REG).first()[0], settings.DIGITS)


def _descends(ratings: DataFrame, trace: DataFrame) -> DataFrame:
    """For each rate the objective before the first epoch, and whether it is finite and falls from there to the end."""
    first = _start(ratings)
    ends = trace.groupBy("lr").agg(
        F.count(F.lit(1)).alias("epochs"), F.min_by("objective", "epoch").alias("_one"), F.max_by("objective", "epoch").alias("_last"),
        F.bool_and(F.col("objective") < float("inf")).alias("finite"),
    )
    falls = (F.col("_one") < first) & (F.col("_last") < F.col("_one"))
    return ends.select("lr", "epochs", F.lit(first).alias("first"), "finite", falls.alias("falls"))


def mf_fit_descends(spark: SparkSession, sf: str) -> DataFrame:
    return _descends(inputs.ratings(spark, sf), mf_fit(spark, sf))


def mf_sweep_descends(spark: SparkSession, sf: str) -> DataFrame:
    return _descends(inputs.ratings(spark, sf), mf_lr_sweep(spark, sf))


def mf_als_fits(spark: SparkSession, sf: str) -> DataFrame:
    """The objective of the first factors, and whether alternating least squares ends below it."""
    ratings = inputs.ratings(spark, sf)
    first = _start(ratings)
    after = factor.mf_objective(ratings, *factor.mf_als(ratings), settings.REG)
    return after.select(F.lit(first).alias("first"), (F.col("objective") < first).alias("falls"))


def mf_als_wide_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Alternating least squares on ids beyond int: the factors found, their least ids, and whether they fit."""
    wide = inputs.ratings(spark, sf).withColumns({c: F.col(c).cast("bigint") + settings.WIDE_IDS for c in ("user", "item")})
    first = _start(wide)
    P, Q = factor.mf_als(wide)
    found = [F.count(F.lit(1)).alias("n"), F.min("id").alias("least")]
    users, items = (f.agg(*found).first() for f in (P, Q))
    counted = [F.lit(users["n"]).alias("users"), F.lit(items["n"]).alias("items")]
    least = [F.lit(users["least"]).alias("least_user"), F.lit(items["least"]).alias("least_item")]
    after = factor.mf_objective(wide, P, Q, settings.REG)
    return after.select(*counted, *least, (F.col("objective") < first).alias("falls"))


def mf_als(spark: SparkSession, sf: str) -> DataFrame:
    P, Q = factor.mf_als(inputs.ratings(spark, sf))
    return P.select(F.lit("p").alias("side"), "*").unionByName(Q.select(F.lit("q").alias("side"), "*"))


# Collaborative filtering

def user_degree(spark: SparkSession, sf: str) -> DataFrame:
    return cf.user_degree(inputs.seen(spark, sf))


def item_degree(spark: SparkSession, sf: str) -> DataFrame:
    return cf.item_degree(inputs.seen(spark, sf))


def item_similarity(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(cf.item_similarity(inputs.seen(spark, sf)), "sim")


def user_similarity(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(cf.user_similarity(inputs.seen(spark, sf)), "sim")


def similar_users(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(cf.similar_users(inputs.seen(spark, sf), settings.SIMILAR), "sim")


def similar_users_top_n(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(cf.similar_users_top_n(inputs.seen(spark, sf), settings.TOP_SCORES, settings.SIMILAR), "sim")


def cf_scores_item(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(cf.cf_scores_item(inputs.seen(spark, sf)), "score")


def cf_scores_user(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(cf.cf_scores_user(inputs.seen(spark, sf)), "score")


def cf_top_n_item(spark: SparkSession, sf: str) -> DataFrame:
    scores = cf.cf_scores_item(inputs.seen(spark, sf), top=settings.TOP_SCORES)
    return _rounded(cf.cf_top_n(scores, settings.TOP_SCORES), "score")


def cf_top_n_user(spark: SparkSession, sf: str) -> DataFrame:
    scores = cf.cf_scores_user(inputs.seen(spark, sf), top=settings.TOP_SCORES)
    return _rounded(cf.cf_top_n(scores, settings.TOP_SCORES), "score")


def cf_top_n_unseen(spark: SparkSession, sf: str) -> DataFrame:
    """The best items that a user has not seen."""
    seen = inputs.seen(spark, sf)
    scores = cf.cf_scores_item(seen, top=settings.TOP_SCORES, unseen=True)
    return _rounded(cf.cf_top_n(scores, settings.TOP_SCORES, seen=seen), "score")


def _report(spark: SparkSession, sf: str, scores: DataFrame) -> DataFrame:
    """The best of the report's items for each of its customers, by name."""
    best = cf.cf_top_n(
        scores, settings.TOP_SCORES, settings.REPORT_CUSTOMERS, F.col("item") < settings.REPORT_ITEMS
    )
    names = inputs.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("item"), F.col("s_name").alias("title"))
    return _rounded(best.join(names, "item"), "score")


def recommendation_report_item(spark: SparkSession, sf: str) -> DataFrame:
    return _report(spark, sf, cf.cf_scores_item(inputs.seen(spark, sf), settings.REPORT_CUSTOMERS))


def recommendation_report_user(spark: SparkSession, sf: str) -> DataFrame:
    return _report(spark, sf, cf.cf_scores_user(inputs.seen(spark, sf), settings.REPORT_CUSTOMERS))


def registered() -> dict[str, Query]:
    plain = [
        mutual_friend_counts, non_friend_pairs, recommend_friends, recommend_friends_hubs, recommend_friends_selected,
        frequent_items, frequent_items_occurrence, frequent_pairs, frequent_pairs_occurrence,
        frequent_triples, frequent_triples_occurrence, frequent_itemsets, frequent_itemsets_fp,
        rules_1to1, rules_2to1, top_rules_1to1, top_rules_2to1,
        lsh_signatures, lsh_candidates, lsh_knn, distances, pair_distances, exact_knn, ann_error, ann_sweep,
        gram_matrix, eigen_sym, svd, svd_project, eigen_reconstruction, svd_reconstruction, svd_leading,
        kmeans_assign_l1, kmeans_assign_l2, kmeans_update, kmeans_cost_drop,
        rating_ranges, mf_init, mf_objective, mf_fit, mf_fit_blocks, mf_lr_sweep, mf_als,
        mf_fit_descends, mf_sweep_descends, mf_als_fits, mf_als_wide_ids,
        user_degree, item_degree, item_similarity, user_similarity, similar_users, similar_users_top_n,
        cf_scores_item, cf_scores_user, cf_top_n_item, cf_top_n_user, cf_top_n_unseen,
        recommendation_report_item, recommendation_report_user,
    ]
    found: dict[str, Query] = {f.__name__: f for f in plain}
    for metric in ("l1", "l2"):
        for init in settings.FIRST_CENTROIDS:
            found[f"kmeans_trace_{metric}_{init}"] = _trace(metric, init)
    return found
