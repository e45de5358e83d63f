from collections import Counter
from itertools import combinations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodeworks.operators import basket

BASKETS = [
    "a b c d", "a b c", "a b c", "a b", "a a b", "c d e", "c d", "e e e e", "b c d", "a c d x", "x",
    "a b d", "b d e", "a a a c", "c c d d",
]


@pytest.fixture
def held(spark):
    return spark.createDataFrame(
        [(n, item) for n, line in enumerate(BASKETS) for item in line.split()], "basket_id bigint, item string"
    )


def brute(support, count):
    lines = [sorted(b.split()) for b in BASKETS]
    lists = lines if count == "occurrence" else [sorted(set(b)) for b in lines]
    f1 = {i: n for i, n in Counter(i for b in lists for i in b).items() if n >= support}
    kept = [[i for i in b if i in f1] for b in lists]
    f2 = {p: n for p, n in Counter(p for b in kept for p in combinations(b, 2)).items() if n >= support}
    c3 = Counter()
    for b in kept:
        mine = sorted({i for p in combinations(b, 2) if p in f2 for i in p})
        c3.update(combinations(mine, 3))
    return f1, f2, {t: n for t, n in c3.items() if n >= support}


def as_rows(counts):
    return sorted(((*((k,) if isinstance(k, str) else k), n) for k, n in counts.items()), key=repr)


@pytest.mark.parametrize("count", ["basket", "occurrence"])
@pytest.mark.parametrize("block_rows", [1, 1024])
def test_levels(held, count, block_rows):
    f1, f2, f3 = brute(3, count)
    assert f3
    assert rows(basket.frequent_items(held, 3, count)) == as_rows(f1)
    pairs = basket.frequent_pairs(held, 3, count, block_rows=block_rows)
    assert rows(pairs) == as_rows(f2)
    assert rows(basket.frequent_triples(held, 3, count, block_rows=block_rows)) == as_rows(f3)
    reused = basket.frequent_triples(held, 3, count, pairs=pairs, block_rows=block_rows)
    assert rows(reused) == as_rows(f3)


def test_repeated_item_pairs_with_itself(held):
    pairs = {(a, b): n for a, b, n in rows(basket.frequent_pairs(held, 3, "occurrence"))}
    assert pairs["e", "e"] == 6
    assert pairs["a", "a"] == 1 + 3


def test_item_at_the_threshold_stays(held):
    n = dict(rows(basket.frequent_items(held, 1)))["x"]
    assert n == 2
    assert "x" in dict(rows(basket.frequent_items(held, 2)))
    assert "x" not in dict(rows(basket.frequent_items(held, 3)))


def test_without_a_small_item_list(held, monkeypatch):
    monkeypatch.setattr(basket, "is_small", lambda *_: False)
    _, f2, f3 = brute(3, "basket")
    assert rows(basket.frequent_pairs(held, 3)) == as_rows(f2)
    assert rows(basket.frequent_triples(held, 3)) == as_rows(f3)


@pytest.mark.parametrize("max_k", [1, 3, 4])
@pytest.mark.parametrize("block_rows", [2, 1024])
def test_itemsets_of_any_size(held, max_k, block_rows):
    sets = [set(b.split()) for b in BASKETS]
    items = sorted(set().union(*sets))
    expected = {
        c: n for k in range(1, max_k + 1) for c in combinations(items, k) if (n := sum(set(c) <= s for s in sets)) >= 1
    }
    expected = {c: n for c, n in expected.items() if n >= 1}
    found = {tuple(r["items"]): r["n"] for r in basket.frequent_itemsets(held, 1, max_k, block_rows=block_rows).collect()}
    assert found == expected


def test_growth_agrees_with_levels(held):
    def sets(frame):
        return {tuple(r["items"]): r["n"] for r in frame.collect()}

    assert sets(basket.frequent_itemsets_fp(held, 3)) == sets(basket.frequent_itemsets(held, 3))


@pytest.mark.parametrize("max_k", [1, 2, 5])
@pytest.mark.parametrize("support", [0, 1, 3, 40])
def test_growth_of_any_size(spark, support, max_k):
    """Sets, repeats, a basket without an id and items without a name."""
    lines = [(n, item) for n, line in enumerate(BASKETS) for item in line.split()]
    lines += [(None, "a"), (None, "b"), (None, "x"), (3, None), (4, None), (5, None), (None, None)]
    held = spark.createDataFrame(lines, "basket_id bigint, item string")
    sets = [{i for b, i in lines if b == n and i} for n in {b for b, _ in lines}]
    items = sorted(set().union(*sets))
    counts = {c: sum(set(c) <= s for s in sets) for k in range(1, max_k + 1) for c in combinations(items, k)}
    found = [(tuple(r["items"]), r["n"]) for r in basket.frequent_itemsets_fp(held, support, max_k).collect()]
    assert sorted(found) == sorted((c, n) for c, n in counts.items() if n and n >= support)


def test_growth_of_no_baskets(held):
    assert basket.frequent_itemsets_fp(held.limit(0), 1).collect() == []


def test_growth_sees_few_different_rows(spark, monkeypatch):
    """Baskets that all differ, as items that meet rarely make them, reach FPGrowth as few different rows."""
    seen = []

    class Watched(basket.FPGrowth):
        def fit(self, rows):
            seen.append((rows.distinct().count(), rows.select(F.max(F.size("items"))).first()[0]))
            return super().fit(rows)

    monkeypatch.setattr(basket, "FPGrowth", Watched)
    lists = [{f"c{n % 2}", "d", *(f"r{(n * n * k + k * 7) % 53:02}" for k in range(1, 7))} for n in range(120)]
    assert len({frozenset(x) for x in lists}) > 50
    held = spark.createDataFrame([(n, i) for n, x in enumerate(lists) for i in sorted(x)], "basket_id bigint, item string")
    found = {tuple(r["items"]): r["n"] for r in basket.frequent_itemsets_fp(held, 20).collect()}
    items = sorted(set().union(*lists))
    counts = {c: sum(set(c) <= x for x in lists) for k in (1, 2, 3) for c in combinations(items, k)}
    assert found == {c: n for c, n in counts.items() if n >= 20}
    assert seen[0][0] < 20 and seen[0][1] <= 3


def test_rules(held):
    f1, f2, f3 = brute(3, "basket")
    items, pairs = basket.frequent_items(held, 3), basket.frequent_pairs(held, 3)
    one = {(r["x"], r["y"]): r["confidence"] for r in basket.rules_1to1(items, pairs).collect()}
    assert one == pytest.approx({k: v for (a, b), n in f2.items() for k, v in (((a, b), n / f1[a]), ((b, a), n / f1[b]))})
    assert all(0 < c <= 1 for c in one.values())
    two = {
        (r["x"], r["y"], r["z"]): r["confidence"]
        for r in basket.rules_2to1(pairs, basket.frequent_triples(held, 3)).collect()
    }
    expected = {}
    for (a, b, c), n in f3.items():
        expected |= {(a, b, c): n / f2[a, b], (a, c, b): n / f2[a, c], (b, c, a): n / f2[b, c]}
    assert two == pytest.approx(expected)


def test_top_rules_order(spark):
    rules = spark.createDataFrame(
        [("b", "a", 1, 0.5), ("a", "c", 1, 0.5), ("a", "b", 1, 0.5), ("z", "a", 1, 0.9)],
        "x string, y string, support bigint, confidence double",
    )
    assert [(r["x"], r["y"]) for r in basket.top_rules(rules, 3).collect()] == [("z", "a"), ("a", "b"), ("a", "c")]
    assert basket.top_rules(rules, 10).count() == 4


def test_unknown_count_mode(held):
    with pytest.raises(ValueError):
        basket.frequent_pairs(held, 3, "weight")


@pytest.mark.parametrize("limit", [10, 0])
def test_hot_baskets_are_broadcast_only_below_the_limit(held, monkeypatch, limit):
    from lodeworks.operators import skew

    monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
    baskets = skew.group_sizes(held.distinct(), ["basket_id"], 2)
    seen = []
    monkeypatch.setattr(basket, "group_sizes", lambda found, *_: seen.append(found) or baskets)
    basket._stem_sizes(held, ["item"], baskets, 2)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (limit == 10)


@pytest.mark.parametrize("count", basket.COUNT_MODES)
def test_sets_are_made_without_a_shuffle_by_basket(held, count, monkeypatch):
    """Once the baskets are gathered, no later step brings their rows together again."""
    for step in ("pairs_within", "group_sizes"):
        monkeypatch.setattr(basket, step, lambda *_, **__: pytest.fail("the baskets are shuffled again"))
    _, f2, f3 = brute(3, count)
    assert rows(basket.frequent_pairs(held, 3, count)) == as_rows(f2)
    assert rows(basket.frequent_triples(held, 3, count)) == as_rows(f3)
