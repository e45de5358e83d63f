"""Pairs inside groups equal brute force, with and without splitting."""

from itertools import combinations

import pytest
from conftest import rows

from lodeworks.operators import skew

GROUPS = {"hot": list(range(40)), "two": [5, 9], "one": [7], "mid": list(range(100, 112))}


def expected():
    return sorted(
        ((key, a, b) for key, members in GROUPS.items() for a, b in combinations(sorted(members), 2)), key=repr
    )


@pytest.fixture
def members(spark):
    return spark.createDataFrame([(k, m) for k, ms in GROUPS.items() for m in ms], "g string, m bigint")


@pytest.mark.parametrize("block_rows", [1, 3, 16, 1024])
def test_every_pair_once(members, block_rows):
    sizes = skew.group_sizes(members, ["g"], block_rows)
    found = skew.pairs_within(members, ["g"], "m", sizes, block_rows=block_rows)
    assert rows(found) == expected()


@pytest.mark.parametrize("block_rows", [3, 1024])
def test_repeats_count_once(members, block_rows):
    twice = members.unionByName(members)
    sizes = skew.group_sizes(twice, ["g"], block_rows)
    found = skew.pairs_within(twice, ["g"], "m", sizes, block_rows=block_rows, repeats=True)
    assert rows(found) == expected()


@pytest.mark.parametrize("block_rows", [3, 1024])
def test_weights_stay_with_their_member(members, block_rows):
    weighted = members.withColumn("w", members["m"] * 10)
    sizes = skew.group_sizes(weighted, ["g"], block_rows)
    found = skew.pairs_within(weighted, ["g"], "m", sizes, carry="w", block_rows=block_rows)
    assert rows(found) == sorted(((g, a, b, 10 * a, 10 * b) for g, a, b in expected()), key=repr)


def test_sizes(members):
    sizes = skew.group_sizes(members, ["g"], 12)
    assert rows(sizes.hot) == [("hot", 40)]
    assert sizes.pairs == len(expected())
    assert sizes.groups == len(GROUPS)
    assert skew.group_sizes(members, ["g"], 40).hot is None
    assert skew.group_sizes(members.limit(0), ["g"]).pairs == 0


def test_no_block_outgrows_its_bound(spark):
    one = spark.range(5000).selectExpr("1 AS g", "id AS m")
    sizes = skew.group_sizes(one, ["g"], 500)
    blocks = skew._blocks(one, ["g"], "m", one["m"], sizes, 500, False)
    biggest = blocks.selectExpr("max(size(_left)) AS l", "max(size(_right)) AS r").first()
    assert max(biggest["l"], biggest["r"]) < 2 * 500
    assert blocks.count() == 10 * 11 / 2


def test_large_work_is_spread(spark):
    few = spark.range(100).selectExpr("id % 10 AS g", "id AS m")
    assert skew.partitioned(few, ["g"], 10.0) is few
    assert skew.partitioned(few, ["g"], 41 * skew.ROWS_PER_PARTITION).rdd.getNumPartitions() == 41


def test_broadcast_only_below_the_limit(spark):
    table = spark.range(20)

    def plan(frame):
        return spark.range(100).join(frame, "id")._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(skew.broadcast_if_small(table, 20))
    assert "strategy=broadcast" not in plan(skew.broadcast_if_small(table, 19))


@pytest.mark.parametrize("limit", [10, 1])
def test_more_hot_groups_than_may_be_broadcast(members, monkeypatch, limit):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
    sizes = skew.group_sizes(members, ["g"], 3)
    plan = sizes.hot.join(members, "g")._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (limit == 10)
    # The stored table is read again, nothing is counted twice.
    assert "Aggregate" not in sizes.hot._jdf.queryExecution().optimizedPlan().toString()
    assert rows(skew.pairs_within(members, ["g"], "m", sizes, block_rows=3)) == expected()
