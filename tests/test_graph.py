import random

import pytest
from conftest import rows

from lodeworks.operators import graph


def both(pairs):
    return [e for a, b in pairs for e in ((a, b), (b, a))]


def frame(spark, edges):
    return spark.createDataFrame(edges, "src bigint, dst bigint")


def people(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id bigint")


def brute(edges):
    """Mutual counts of each pair, then the non-friends of each user in order."""
    lists = {}
    for a, b in edges:
        if a != b:
            lists.setdefault(a, set()).add(b)
    counts = {}
    for friends in lists.values():
        for u in friends:
            for v in friends:
                if u < v:
                    counts[u, v] = counts.get((u, v), 0) + 1
    best = {}
    for (u, v), n in counts.items():
        if v not in lists.get(u, ()) and u not in lists.get(v, ()):
            best.setdefault(u, []).append((-n, v))
            best.setdefault(v, []).append((-n, u))
    return counts, {u: sorted(c) for u, c in best.items()}


def test_counts_and_exclusion(spark):
    edges = both([(1, 9), (1, 10), (2, 9), (2, 10), (1, 2), (9, 3)])
    counts, _ = brute(edges)
    found = graph.mutual_friend_counts(frame(spark, edges))
    assert rows(found) == sorted(((u, v, n) for (u, v), n in counts.items()), key=repr)
    assert (9, 10, 2) in rows(found)
    kept = graph.drop_connected(found, frame(spark, edges))
    assert (1, 2, 2) not in rows(kept) and (9, 10, 2) in rows(kept)


def test_duplicates_and_self_loops_do_not_count(spark):
    clean = both([(1, 2), (1, 3)])
    noisy = clean + [(1, 2), (1, 1), (3, 3)]
    assert rows(graph.mutual_friend_counts(frame(spark, noisy))) == [(2, 3, 1)]


def test_one_sided_edge_is_a_friendship(spark):
    edges = both([(1, 2), (1, 3)]) + [(3, 2)]
    assert graph.drop_connected(graph.mutual_friend_counts(frame(spark, edges)), frame(spark, edges)).count() == 0


def test_ranking_ties_and_users_without_candidates(spark):
    edges = both([(1, 9), (1, 10), (1, 2), (5, 9), (5, 2)])
    found = graph.recommend_friends(frame(spark, edges), people(spark, [1, 2, 5, 9, 10, 77]), n=2)
    ranked = {}
    for r in found.orderBy("user", "rank").collect():
        ranked.setdefault(r["user"], []).append(r["candidate"])
    assert ranked[77] == [None]
    assert ranked[2] == [9, 10]
    assert ranked[10] == [2, 9]
    assert ranked[1] == [5]


def test_hub_graph_against_brute_force(spark):
    pairs = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(1, 50)] + [(i, i + 7) for i in range(1, 40)]
    edges = both(pairs)
    counts, best = brute(edges)
    small_blocks = graph.mutual_friend_counts(frame(spark, edges), block_rows=7)
    assert rows(small_blocks) == sorted(((u, v, n) for (u, v), n in counts.items()), key=repr)
    everyone = people(spark, range(60))
    whole = graph.recommend_friends(frame(spark, edges), everyone, n=10, block_rows=7)
    expected = [
        (u, v, -n, k + 1) for u in range(60) for k, (n, v) in enumerate(best.get(u, [])[:10])
    ] + [(u, None, None, None) for u in range(60) if u not in best]
    assert rows(whole) == sorted(expected, key=repr)
    wanted = [0, 3, 17, 59]
    some = graph.recommend_friends(frame(spark, edges), everyone, n=10, users=wanted)
    assert rows(some) == sorted((r for r in expected if r[0] in wanted), key=repr)


def ranked_rows(edges, ids, n):
    _, best = brute(edges)
    return sorted(
        [(u, v, -m, k + 1) for u in ids for k, (m, v) in enumerate(best.get(u, [])[:n])]
        + [(u, None, None, None) for u in ids if u not in best],
        key=repr,
    )


@pytest.mark.parametrize("offered", [1024, 4])
def test_hubs_without_their_pairs(spark, offered):
    draw = random.Random(8)
    pairs = [(h, i) for h, share in ((0, 0.9), (1, 0.6), (2, 0.5)) for i in range(3, 70) if draw.random() < share]
    pairs += [tuple(draw.sample(range(3, 75), 2)) for _ in range(90)]
    # A user next to nearly everyone with a low id cannot be served by few offers.
    pairs += [(74, i) for i in range(3, 40)]
    edges = both(pairs) + [(50, 3), (3, 60)]
    found = graph.recommend_friends(
        frame(spark, edges), people(spark, range(80)), n=5, block_rows=8, hub_pairs=300, offered=offered
    )
    assert rows(found) == ranked_rows(edges, range(80), 5)


@pytest.mark.parametrize("hub_pairs", [0, 40, 1e9])
def test_any_number_of_hubs(spark, hub_pairs):
    draw = random.Random(3)
    pairs = [(h, i) for h in range(25) for i in range(25, 75) if draw.random() < 0.1 + h / 40]
    pairs += [tuple(draw.sample(range(75), 2)) for _ in range(60)] + [(0, 80), (1, 80), (0, 81), (1, 81)]
    edges = both(pairs)
    found = graph.recommend_friends(
        frame(spark, edges), people(spark, range(85)), n=6, block_rows=4, hub_pairs=hub_pairs, offered=10
    )
    assert rows(found) == ranked_rows(edges, range(85), 6)


def test_hub_choice(spark):
    edges = both([(0, i) for i in range(1, 30)] + [(1, i) for i in range(2, 20)])
    lists = graph._adjacency(frame(spark, edges), "src", "dst")

    def hubs(block_rows, hub_pairs):
        found = graph._hubs(graph.group_sizes(lists, ["src"], block_rows), hub_pairs)
        return found and sorted(r["src"] for r in found.collect())

    assert hubs(5, 100) == [0, 1]
    assert hubs(5, 200) == [0]
    assert hubs(50, 200) is None


def test_wedges_are_counted_in_as_many_parts_as_they_need(spark, monkeypatch):
    from lodeworks.operators import skew

    monkeypatch.setattr(skew, "ROWS_PER_PARTITION", 2)
    edges = spark.createDataFrame([(s, d) for s in range(6) for d in range(6)], "src bigint, dst bigint")
    counts = graph.mutual_friend_counts(edges)
    assert "RepartitionByExpression [a" in counts._jdf.queryExecution().optimizedPlan().toString()
    assert {r["n"] for r in counts.collect()} == {4}
