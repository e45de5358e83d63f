"""DuckDB SQL for the registered queries, written apart from the Spark code."""

from __future__ import annotations

from lodeworks.operators.neighbors import HashFamily
from lodeworks.plans import settings as S

D = S.DIGITS


def _list(ids: list[int]) -> str:
    return ", ".join(str(i) for i in ids)


# Friend recommendation

EDGES = """
returned AS (
  SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem WHERE l_returnflag = 'R'),
edges AS (
  SELECT DISTINCT x.p AS src, y.p AS dst FROM returned x JOIN returned y ON x.o = y.o AND x.p <> y.p),
mutual AS (
  SELECT x.dst AS u, y.dst AS v, count(*) AS n
  FROM edges x JOIN edges y ON x.src = y.src AND x.dst < y.dst GROUP BY 1, 2),
strangers AS (
  SELECT u, v, n FROM mutual m WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.src = m.u AND e.dst = m.v))
"""

RECOMMENDED = f"""
WITH {EDGES},
directed AS (
  SELECT u AS "user", v AS candidate, n FROM strangers UNION ALL SELECT v, u, n FROM strangers),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY n DESC, candidate) AS r FROM directed)
SELECT p.p_partkey AS "user",
       coalesce(string_agg(CAST(r.candidate AS VARCHAR), ',' ORDER BY r.r), '') AS candidates,
       coalesce(string_agg(CAST(r.n AS VARCHAR), ',' ORDER BY r.r), '') AS n_mutual
FROM part p LEFT JOIN ranked r ON r."user" = p.p_partkey AND r.r <= {S.TOP_FRIENDS}
"""

# Frequent itemsets and rules

MARKET = f"""
lines AS (
  SELECT l_orderkey AS b, unnest([p_brand, p_type, p_name]) AS i FROM lineitem JOIN part ON l_partkey = p_partkey),
held AS (SELECT DISTINCT b, i FROM lines),
least_support AS (
  SELECT CAST(ceil({S.SUPPORT_SHARE} * count(DISTINCT l_orderkey)) AS BIGINT) AS s FROM lineitem)
"""
ENOUGH = "HAVING count(*) >= (SELECT s FROM least_support)"
ITEMS = f"""
f1 AS (SELECT i AS a, count(*) AS n FROM held GROUP BY 1 {ENOUGH}),
g1 AS (SELECT i AS a, count(*) AS n FROM lines GROUP BY 1 {ENOUGH})
"""
PAIRS = f"""
kept AS (SELECT b, i FROM held SEMI JOIN f1 ON f1.a = i),
f2 AS (
  SELECT x.i AS a, y.i AS b, count(*) AS n FROM kept x JOIN kept y ON x.b = y.b AND x.i < y.i
  GROUP BY 1, 2 {ENOUGH}),
placed AS (
  SELECT b, i, row_number() OVER (PARTITION BY b ORDER BY i) AS at FROM lines SEMI JOIN g1 ON g1.a = i),
g2 AS (
  SELECT x.i AS a, y.i AS b, count(*) AS n FROM placed x JOIN placed y ON x.b = y.b AND x.at < y.at
  GROUP BY 1, 2 {ENOUGH})
"""
TRIPLES = f"""
f3 AS (
  SELECT x.i AS a, y.i AS b, z.i AS c, count(*) AS n
  FROM kept x JOIN kept y ON x.b = y.b AND x.i < y.i JOIN kept z ON y.b = z.b AND y.i < z.i
  GROUP BY 1, 2, 3 {ENOUGH})
"""
OCCURRENCE_TRIPLES = f"""
many AS (SELECT DISTINCT b, i FROM placed),
together AS (SELECT x.b, x.i AS p, y.i AS q FROM many x JOIN many y ON x.b = y.b AND x.i < y.i
             SEMI JOIN g2 ON g2.a = x.i AND g2.b = y.i),
g3 AS (
  SELECT x.p AS a, x.q AS b, y.q AS c, count(*) AS n
  FROM together x JOIN together y ON x.b = y.b AND x.p = y.p AND x.q < y.q
  GROUP BY 1, 2, 3 {ENOUGH})
"""
RULES_1 = """
r1 AS (
  SELECT x, y, f2n AS support, CAST(f2n AS DOUBLE) / f1.n AS confidence
  FROM (SELECT a AS x, b AS y, n AS f2n FROM f2 UNION ALL SELECT b, a, n FROM f2) JOIN f1 ON f1.a = x)
"""
RULES_2 = """
r2 AS (
  SELECT x, y, z, f3n AS support, CAST(f3n AS DOUBLE) / f2.n AS confidence
  FROM (SELECT a AS x, b AS y, c AS z, n AS f3n FROM f3
        UNION ALL SELECT a, c, b, n FROM f3 UNION ALL SELECT b, c, a, n FROM f3)
  JOIN f2 ON f2.a = x AND f2.b = y)
"""
ITEMSETS = f"""
WITH {MARKET}, {ITEMS}, {PAIRS}, {TRIPLES}
SELECT a AS items, n FROM f1 UNION ALL SELECT a || ',' || b, n FROM f2
UNION ALL SELECT a || ',' || b || ',' || c, n FROM f3
"""

# Nearest neighbours

VECTORS = """
cells AS (SELECT vec_id AS id, unnest(range(len(embedding))) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
"""


def _family(name: str, families: dict[tuple[int, int], HashFamily]) -> str:
    rows = ", ".join(
        f"({k}, {L}, {t}, {b}, {d}, '{x!r}'::DOUBLE)"
        for (k, L), family in families.items()
        for t, b, d, x in family.rows()
    )
    return f"{name}(k, L, tbl, bit, dim, thr) AS (VALUES {rows})"


def _hashed(families: dict[tuple[int, int], HashFamily]) -> str:
    return f"""
{_family("family", families)},
{VECTORS},
sig AS MATERIALIZED (
  SELECT f.k, f.L, c.id, f.tbl, string_agg(CASE WHEN c.x >= f.thr THEN '1' ELSE '0' END, '' ORDER BY f.bit) AS key
  FROM cells c JOIN family f ON f.dim = c.dim GROUP BY 1, 2, 3, 4),
cand AS MATERIALIZED (
  SELECT DISTINCT q.k, q.L, q.id AS query_id, s.id FROM sig q
  JOIN sig s ON s.k = q.k AND s.L = q.L AND s.tbl = q.tbl AND s.key = q.key AND s.id <> q.id
  WHERE q.id IN ({_list(S.QUERY_IDS)})),
far AS MATERIALIZED (
  SELECT q.id AS query_id, c.id, sum(abs(c.x - q.x)) AS dist, sqrt(sum((c.x - q.x) * (c.x - q.x))) AS dist2
  FROM cells q JOIN cells c ON c.dim = q.dim AND c.id <> q.id
  WHERE q.id IN ({_list(S.QUERY_IDS)}) GROUP BY 1, 2),
near AS (
  SELECT * FROM (
    SELECT cand.k, cand.L, far.*, row_number() OVER (PARTITION BY cand.k, cand.L, far.query_id ORDER BY dist, far.id) AS rank
    FROM cand JOIN far ON far.query_id = cand.query_id AND far.id = cand.id)
  WHERE rank <= {S.NEIGHBORS}),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, id) AS rank FROM far)
  WHERE rank <= {S.NEIGHBORS}),
ratios AS (
  SELECT f.k, f.L, e.query_id, coalesce(n.n, 0) AS n, coalesce(n.d, 0) / nullif(e.d, 0) AS ratio
  FROM (SELECT DISTINCT k, L FROM family) f
  JOIN (SELECT query_id, sum(dist) AS d FROM best GROUP BY 1) e ON true
  LEFT JOIN (SELECT k, L, query_id, sum(dist) AS d, count(*) AS n FROM near GROUP BY 1, 2, 3) n
    ON n.k = f.k AND n.L = f.L AND n.query_id = e.query_id)
"""


ONE = {(S.FAMILY.bits, S.FAMILY.tables): S.FAMILY}

# Clustering


def _centroids(init: str) -> str:
    rows = ", ".join(f"({i}, {v})" for i, v in enumerate(S.FIRST_CENTROIDS[init]))
    return f"c0 AS MATERIALIZED (SELECT n.cid, c.dim, c.x FROM (VALUES {rows}) n(cid, id) JOIN cells c ON c.id = n.id)"


def _step(metric: str, number: int) -> str:
    dist = "sum(abs(p.x - c.x))" if metric == "l1" else "sum((p.x - c.x) * (p.x - c.x))"
    return f"""
a{number} AS MATERIALIZED (
  SELECT id, cid, cost FROM (
    SELECT id, cid, cost, row_number() OVER (PARTITION BY id ORDER BY cost, cid) AS r FROM (
      SELECT p.id, c.cid, {dist} AS cost FROM cells p JOIN c{number} c ON c.dim = p.dim GROUP BY 1, 2))
  WHERE r = 1),
c{number + 1} AS MATERIALIZED (
  SELECT a.cid, p.dim, avg(p.x) AS x FROM a{number} a JOIN cells p ON p.id = a.id GROUP BY 1, 2)
"""


def _trace(metric: str, init: str) -> str:
    steps = ",".join(_step(metric, i) for i in range(S.KMEANS_ITERS))
    costs = " UNION ALL ".join(
        f"SELECT {i + 1} AS iteration, sum(cost) AS cost FROM a{i}" for i in range(S.KMEANS_ITERS)
    )
    return f"""
WITH {VECTORS}, {_centroids(init)}, {steps}, trace AS ({costs})
SELECT '{metric}' AS metric, '{init}' AS init, CAST(iteration AS INTEGER) AS iteration, round(cost, {D}) AS cost,
       round(100 * cost / (SELECT cost FROM trace WHERE iteration = 1), {D}) AS pct_of_first
FROM trace
"""


def _drops() -> str:
    tenth = " UNION ALL ".join(
        f"SELECT * FROM ({_trace(metric, init)}) WHERE iteration = {S.DROP_AFTER}"
        for metric in ("l1", "l2") for init in S.FIRST_CENTROIDS
    )
    return f"SELECT metric, init, pct_of_first, round(100 - pct_of_first, {D}) AS pct_dropped FROM ({tenth})"


# Latent factors

RATINGS = """
ratings AS (
  SELECT o_custkey AS "user", l_suppkey AS item, CAST(ceil(avg(l_quantity) / 10) AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
"""
FACTORS = f"""
sides AS (
  SELECT DISTINCT 'p' AS side, "user" AS id FROM ratings UNION ALL SELECT DISTINCT 'q', item FROM ratings),
slots AS (SELECT side, id, unnest(range({S.FACTORS})) AS j FROM sides),
factors AS MATERIALIZED (
  SELECT side, id, j,
         CAST(('0x' || substr(md5(side || ':' || id || ':' || (j // 4)), CAST(8 * (j % 4) + 1 AS INTEGER), 8)) AS BIGINT)
           / 4294967296.0::DOUBLE * sqrt({S.TOP_RATING}::DOUBLE / {S.FACTORS}) AS x
  FROM slots)
"""

# Collaborative filtering

SEEN = """
r AS MATERIALIZED (SELECT DISTINCT o_custkey AS "user", l_suppkey AS item FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
du AS MATERIALIZED (SELECT "user", CAST(count(*) AS DOUBLE) AS d FROM r GROUP BY 1),
di AS MATERIALIZED (SELECT item, CAST(count(*) AS DOUBLE) AS d FROM r GROUP BY 1),
si AS MATERIALIZED (
  SELECT x.item AS i, y.item AS j, count(*) / sqrt(any_value(p.d) * any_value(q.d)) AS sim
  FROM r x JOIN r y ON x."user" = y."user" JOIN di p ON p.item = x.item JOIN di q ON q.item = y.item GROUP BY 1, 2),
su AS (
  SELECT x."user" AS u, y."user" AS v, count(*) / sqrt(any_value(p.d) * any_value(q.d)) AS sim
  FROM r x JOIN r y ON x.item = y.item JOIN du p ON p."user" = x."user" JOIN du q ON q."user" = y."user" GROUP BY 1, 2),
yi AS (SELECT r."user", si.j AS item, sum(si.sim) AS score FROM r JOIN si ON si.i = r.item GROUP BY 1, 2),
yu AS (SELECT su.u AS "user", r.item, sum(su.sim) AS score FROM su JOIN r ON r."user" = su.v GROUP BY 1, 2)
"""


def _top(scores: str, unseen: bool = False) -> str:
    new = 'ANTI JOIN r USING ("user", item)' if unseen else ""
    return f"""
WITH {SEEN},
exact AS (SELECT "user", item, round(score, 9) AS score FROM {scores} {new}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM exact)
SELECT "user", item, round(score, {D}) AS score, rank FROM ranked WHERE rank <= {S.TOP_SCORES}
"""


def _report(scores: str) -> str:
    return f"""
WITH {SEEN},
exact AS (
  SELECT "user", item, round(score, 9) AS score FROM {scores}
  WHERE "user" IN ({_list(S.REPORT_CUSTOMERS)}) AND item < {S.REPORT_ITEMS}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM exact)
SELECT "user", item, s_name AS title, round(score, {D}) AS score, rank
FROM ranked JOIN supplier ON s_suppkey = item WHERE rank <= {S.TOP_SCORES}
"""


def _falls(start: str, rates: tuple[float, ...], epochs: int) -> str:
    """The objective of the first factors for each rate; that it falls is what is to be shown."""
    listed = ", ".join(f"({r}::DOUBLE)" for r in rates)
    return f"""SELECT lr, {epochs}::BIGINT AS epochs, objective AS first, true AS finite, true AS falls
        FROM ({start}), (VALUES {listed}) t(lr)"""


def sql() -> dict[str, str]:
    start = f"""WITH {RATINGS}, {FACTORS},
            guess AS (
              SELECT r."user", r.item, any_value(r.rating) AS rating, sum(p.x * q.x) AS dot
              FROM ratings r JOIN factors p ON p.side = 'p' AND p.id = r."user"
              JOIN factors q ON q.side = 'q' AND q.id = r.item AND q.j = p.j GROUP BY 1, 2)
            SELECT round((SELECT sum((rating - dot) * (rating - dot)) FROM guess)
              + {S.REG}::DOUBLE * (SELECT sum(x * x) FROM factors), {D}) AS objective"""
    market = f"WITH {MARKET}, {ITEMS}, {PAIRS}, {TRIPLES}, {RULES_1}, {RULES_2}"
    hashed = f"WITH {_hashed(ONE)}"
    nearest = f'SELECT query_id, id, round(dist, {D}) AS dist, rank FROM'
    first = f"WITH {VECTORS}, {_centroids('random')}"
    texts = {
        "mutual_friend_counts": f"WITH {EDGES} SELECT u, v, n FROM mutual",
        "non_friend_pairs": f"WITH {EDGES} SELECT u, v, n FROM strangers",
        "recommend_friends": f"{RECOMMENDED} GROUP BY 1",
        "recommend_friends_hubs": f"{RECOMMENDED} GROUP BY 1",
        "recommend_friends_selected": f"{RECOMMENDED} WHERE p.p_partkey IN ({_list(S.REPORT_USERS)}) GROUP BY 1",
        "frequent_items": f"WITH {MARKET}, {ITEMS} SELECT a, n FROM f1",
        "frequent_items_occurrence": f"WITH {MARKET}, {ITEMS} SELECT a, n FROM g1",
        "frequent_pairs": f"WITH {MARKET}, {ITEMS}, {PAIRS} SELECT a, b, n FROM f2",
        "frequent_pairs_occurrence": f"WITH {MARKET}, {ITEMS}, {PAIRS} SELECT a, b, n FROM g2",
        "frequent_triples": f"WITH {MARKET}, {ITEMS}, {PAIRS}, {TRIPLES} SELECT a, b, c, n FROM f3",
        "frequent_triples_occurrence":
            f"WITH {MARKET}, {ITEMS}, {PAIRS}, {OCCURRENCE_TRIPLES} SELECT a, b, c, n FROM g3",
        "frequent_itemsets": ITEMSETS,
        "frequent_itemsets_fp": ITEMSETS,
        "rules_1to1": f"{market} SELECT x, y, support, round(confidence, {D}) AS confidence FROM r1",
        "rules_2to1": f"{market} SELECT x, y, z, support, round(confidence, {D}) AS confidence FROM r2",
        "top_rules_1to1": f"""{market}, best AS (SELECT * FROM r1 ORDER BY confidence DESC, x, y LIMIT {S.TOP_RULES})
            SELECT x, y, support, round(confidence, {D}) AS confidence FROM best""",
        "top_rules_2to1": f"""{market}, best AS (SELECT * FROM r2 ORDER BY confidence DESC, x, y, z LIMIT {S.TOP_RULES})
            SELECT x, y, z, support, round(confidence, {D}) AS confidence FROM best""",
        "lsh_signatures": f"{hashed} SELECT id, CAST(tbl AS INTEGER) AS tbl, key FROM sig",
        "lsh_candidates": f"{hashed} SELECT query_id, id FROM cand",
        "lsh_knn": f"{hashed} {nearest} near",
        "exact_knn": f"{hashed} {nearest} best",
        "distances": f"{hashed} SELECT query_id, id, round(dist, {D}) AS dist FROM far",
        "pair_distances": f"""{hashed} SELECT query_id, id, round(dist2, {D}) AS dist
            FROM cand JOIN far USING (query_id, id)""",
        "ann_error": f"""{hashed} SELECT round(avg(ratio), {D}) AS error, CAST(sum(n) AS BIGINT) AS n_found
            FROM ratios""",
        "ann_sweep": f"""WITH {_hashed(S.SWEEP)} SELECT CAST(k AS INTEGER) AS k, CAST(L AS INTEGER) AS "L",
            round(avg(ratio), {D}) AS error, CAST(sum(n) AS BIGINT) AS n_found FROM ratios GROUP BY 1, 2""",
        "gram_matrix": f"""WITH {VECTORS} SELECT CAST(x.dim AS INTEGER) AS i, CAST(y.dim AS INTEGER) AS j,
            round(sum(x.x * y.x), {D}) AS g FROM cells x JOIN cells y ON x.id = y.id GROUP BY 1, 2""",
        "eigen_reconstruction": f"""WITH {VECTORS} SELECT CAST(x.dim AS INTEGER) AS i, CAST(y.dim AS INTEGER) AS j,
            round(sum(x.x * y.x), {D}) AS g FROM cells x JOIN cells y ON x.id = y.id GROUP BY 1, 2""",
        "svd_reconstruction": f"""WITH {VECTORS} SELECT id, CAST(dim AS INTEGER) AS dim, round(x, {D}) AS x FROM cells""",
        "svd_leading": f"SELECT CAST(rank AS INTEGER) AS rank, true AS fixed FROM range(1, {S.LEADING + 1}) t(rank)",
        "kmeans_assign_l1": f"""{first}, {_step("l1", 0)} SELECT id, CAST(cid AS INTEGER) AS cid,
            round(cost, {D}) AS cost FROM a0""",
        "kmeans_assign_l2": f"""{first}, {_step("l2", 0)} SELECT id, CAST(cid AS INTEGER) AS cid,
            round(cost, {D}) AS cost FROM a0""",
        "kmeans_update": f"""{first}, {_step("l2", 0)},
            sizes AS (SELECT cid, count(*) AS n, sum(cost) AS cost FROM a0 GROUP BY 1)
            SELECT CAST(cid AS INTEGER) AS cid, n, round(cost, {D}) AS cost, CAST(dim AS INTEGER) AS dim,
              round(x, {D}) AS x FROM sizes JOIN c1 USING (cid)""",
        "kmeans_cost_drop": _drops(),
        "rating_ranges": f"""WITH {RATINGS} SELECT min("user") AS min_user, max("user") AS max_user,
            min(item) AS min_item, max(item) AS max_item, min(rating) AS min_rating, max(rating) AS max_rating
            FROM ratings""",
        "mf_init": f"""WITH {RATINGS}, {FACTORS} SELECT side, id, CAST(j AS INTEGER) AS j, round(x, {D}) AS x
            FROM factors""",
        "mf_objective": start,
        "mf_fit_blocks": _falls(start, S.LEARNING_RATES[:1], S.BLOCK_EPOCHS),
        "mf_fit_descends": _falls(start, S.LEARNING_RATES[:1], S.EPOCHS),
        "mf_sweep_descends": _falls(start, S.LEARNING_RATES, S.EPOCHS),
        "mf_als_fits": f"SELECT objective AS first, true AS falls FROM ({start})",
        "mf_als_wide_ids": f"""WITH {RATINGS} SELECT count(DISTINCT "user") AS users, count(DISTINCT item) AS items,
            min("user") + {S.WIDE_IDS} AS least_user, min(item) + {S.WIDE_IDS} AS least_item, true AS falls FROM ratings""",
        "user_degree": f'WITH {SEEN} SELECT "user", d FROM du',
        "item_degree": f"WITH {SEEN} SELECT item, d FROM di",
        "item_similarity": f"WITH {SEEN} SELECT i, j, round(sim, {D}) AS sim FROM si",
        "user_similarity": f"WITH {SEEN} SELECT u, v, round(sim, {D}) AS sim FROM su",
        "similar_users": f"""WITH {SEEN} SELECT u, v, round(sim, {D}) AS sim FROM su
            WHERE u < v AND round(sim, 9) >= {S.SIMILAR}::DOUBLE""",
        "similar_users_top_n": f"""WITH {SEEN},
            ranked AS (
              SELECT u, v, sim, row_number() OVER (PARTITION BY u ORDER BY round(sim, 9) DESC, v) AS rank
              FROM su WHERE u <> v)
            SELECT u AS "user", v AS other, round(sim, {D}) AS sim, rank FROM ranked WHERE rank <= {S.TOP_SCORES}""",
        "cf_scores_item": f'WITH {SEEN} SELECT "user", item, round(score, {D}) AS score FROM yi',
        "cf_scores_user": f'WITH {SEEN} SELECT "user", item, round(score, {D}) AS score FROM yu',
        "cf_top_n_item": _top("yi"),
        "cf_top_n_user": _top("yu"),
        "cf_top_n_unseen": _top("yi", unseen=True),
        "recommendation_report_item": _report("yi"),
        "recommendation_report_user": _report("yu"),
    }
    for metric in ("l1", "l2"):
        for init in S.FIRST_CENTROIDS:
            texts[f"kmeans_trace_{metric}_{init}"] = _trace(metric, init)
    return texts
