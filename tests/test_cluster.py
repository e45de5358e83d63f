import numpy as np
import pytest

from lodeworks.operators import cluster


def table(spark, data):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id bigint, v array<double>")


def lloyd(data, centers, metric, iters):
    costs = []
    for _ in range(iters):
        gaps = {c: np.abs(data - m).sum(1) if metric == "l1" else ((data - m) ** 2).sum(1) for c, m in centers.items()}
        cids = sorted(gaps)
        nearest = np.array(cids)[np.argmin([gaps[c] for c in cids], axis=0)]
        costs.append(float(np.min([gaps[c] for c in cids], axis=0).sum()))
        centers = {c: data[nearest == c].mean(axis=0) for c in cids if (nearest == c).any()}
    return costs, centers


def test_tie_goes_to_the_lower_id(spark):
    found = cluster.kmeans_assign(table(spark, [[0, 0], [2, 0]]), {7: [1, 0], 3: [-1, 0]}).orderBy("id").collect()
    assert [(r["cid"], r["cost"]) for r in found] == [(3, 1.0), (7, 1.0)]


def test_costs_per_metric(spark):
    points, center = table(spark, [[3, 4]]), {0: [0, 0]}
    assert cluster.kmeans_assign(points, center, "l2").first()["cost"] == 25
    assert cluster.kmeans_assign(points, center, "l1").first()["cost"] == 7


def test_empty_cluster_vanishes(spark):
    points = table(spark, [[0, 0], [1, 0]])
    start = {0: [0, 0], 1: [50, 50]}
    updated = cluster.kmeans_update(cluster.kmeans_assign(points, start)).collect()
    assert [(r["cid"], r["c"], r["n"], r["cost"]) for r in updated] == [(0, [0.5, 0.0], 2, 1.0)]
    last, _ = cluster.kmeans_fit(points, {"x": start}, ["l2"], 3)
    assert [r["cid"] for r in last.collect()] == [0]


def test_all_runs_against_plain_loop(spark):
    data = np.random.default_rng(1).normal(size=(200, 5)) + np.repeat(np.eye(5) * 4, 40, axis=0)
    first = {"a": {i: data[i] for i in range(4)}, "b": {i: data[50 * i] for i in range(4)}}
    last, trace = cluster.kmeans_fit(table(spark, data).repartition(4), first, iters=12)
    for metric in ("l2", "l1"):
        for name, start in first.items():
            costs, centers = lloyd(data, start, metric, 12)
            mine = trace.where((trace.metric == metric) & (trace.init == name)).orderBy("iteration").collect()
            assert [r["cost"] for r in mine] == pytest.approx(costs)
            assert mine[9]["pct_of_first"] == pytest.approx(100 * costs[9] / costs[0])
            found = {r["cid"]: r["c"] for r in last.where((last.metric == metric) & (last.init == name)).collect()}
            assert set(found) == set(centers)
            assert all(found[c] == pytest.approx(list(m)) for c, m in centers.items())
            if metric == "l2":
                assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))
    drops = cluster.cost_drop(trace).collect()
    assert len(drops) == 4 and all(r["pct_dropped"] == pytest.approx(100 - r["pct_of_first"]) for r in drops)


def test_too_many_centroids(spark, monkeypatch):
    monkeypatch.setattr(cluster, "MAX_CENTROID_CELLS", 3)
    centers = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 1.0])], "cid int, c array<double>")
    with pytest.raises(ValueError):
        cluster.kmeans_assign(table(spark, [[0, 0]]), centers)
