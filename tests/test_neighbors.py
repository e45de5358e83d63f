import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodeworks.operators import neighbors as nb


def table(spark, data):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id bigint, v array<double>")


@pytest.fixture
def data():
    return np.random.default_rng(3).integers(0, 256, size=(60, 12)).astype(float)


def brute_keys(v, family):
    return ["".join("1" if v[d] >= x else "0" for d, x in zip(ds, cs)) for ds, cs in zip(family.dims, family.thresholds)]


def brute_knn(data, q, n, among=None):
    order = sorted(
        (float(np.abs(data[i] - data[q]).sum()), i) for i in range(len(data)) if i != q and (among is None or i in among)
    )
    return order[:n]


def test_family_draws(spark):
    family = nb.lsh_family(k=24, L=10, dims=400, lo=0, hi=255, seed=1)
    listed = family.rows()
    assert len(listed) == 240 and family == nb.lsh_family(seed=1)
    assert all(0 <= d < 400 and 0 <= x <= 255 and x == int(x) for _, _, d, x in listed)
    tight = nb.lsh_family(k=50, L=4, dims=2, lo=0, hi=1, seed=1)
    assert {x for *_, x in tight.rows()} == {0.0, 1.0}
    real = nb.lsh_family(k=50, L=4, dims=2, lo=-0.5, hi=0.5, seed=1)
    assert all(-0.5 <= x < 0.5 for *_, x in real.rows())


def test_l1_of_a_small_case(spark):
    found = nb.distances(table(spark, [[1, 2, 3, 4], [2, 3, 2, 3]]), [0])
    assert rows(found) == [(0, 1, 4.0)]
    pairs = spark.createDataFrame([(0, 1)], "query_id bigint, id bigint")
    both = table(spark, [[1, 2, 3, 4], [2, 3, 2, 3]])
    assert rows(nb.pair_distances(pairs, both)) == [(0, 1, 4.0)]
    assert rows(nb.pair_distances(pairs, both, "l2")) == [(0, 1, 2.0)]


def test_value_equal_to_the_threshold_sets_the_bit(spark):
    family = nb.HashFamily(((0, 1), (1, 0)), ((5.0, 5.0), (4.9, 5.1)))
    found = nb.lsh_signatures(table(spark, [[5, 4.9], [4.9, 5]]), family)
    assert rows(found) == [(0, 0, "10"), (0, 1, "10"), (1, 0, "01"), (1, 1, "10")]


def test_signatures_and_candidates(spark, data):
    family = nb.lsh_family(k=3, L=4, dims=12, seed=5)
    signatures = nb.lsh_signatures(table(spark, data), family)
    keys = [brute_keys(v, family) for v in data]
    assert rows(signatures) == sorted(((i, t, key) for i, k in enumerate(keys) for t, key in enumerate(k)), key=repr)
    queries = [0, 7, 59]
    expected = sorted(
        ((q, i) for q in queries for i in range(len(data)) if i != q and any(a == b for a, b in zip(keys[q], keys[i]))),
        key=repr,
    )
    assert rows(nb.lsh_candidates(signatures, queries)) == expected


def test_lsh_knn_and_error(spark, data):
    family = nb.lsh_family(k=10, L=3, dims=12, seed=5)
    keys = [brute_keys(v, family) for v in data]
    vectors, queries = table(spark, data), [0, 7, 20, 59]
    expected, ratios, n_found = [], [], 0
    for q in queries:
        mates = {i for i in range(len(data)) if any(a == b for a, b in zip(keys[q], keys[i]))}
        near = brute_knn(data, q, 3, mates)
        expected += [(q, i, d, r + 1) for r, (d, i) in enumerate(near)]
        ratios.append(sum(d for d, _ in near) / sum(d for d, _ in brute_knn(data, q, 3)))
        n_found += len(near)
    lsh, exact = nb.lsh_knn(vectors, family, queries, 3), nb.exact_knn(vectors, queries, 3)
    assert rows(lsh) == sorted(expected, key=repr)
    assert n_found < 12
    error = nb.ann_error(lsh, exact).first()
    assert error["n_found"] == n_found and error["error"] == pytest.approx(np.mean(ratios))


def test_exact_knn_ties_passes_and_zero_distance(spark, monkeypatch):
    monkeypatch.setattr(nb, "QUERIES_PER_PASS", 2)
    data = np.array([[0, 0], [0, 0], [1, 0], [0, 1], [9, 9], [9, 9.5]], dtype=float)
    queries = [0, 3, 4, 5, 1]
    found = nb.exact_knn(table(spark, data), queries, 2)
    expected = [(q, i, d, r + 1) for q in queries for r, (d, i) in enumerate(brute_knn(data, q, 2))]
    assert rows(found) == sorted(expected, key=repr)
    assert (0, 1, 0.0, 1) in expected


def test_l2_and_unknown_metric(spark, data):
    found = nb.distances(table(spark, data), [4], "l2")
    assert {i: d for _, i, d in rows(found)} == pytest.approx(
        {i: float(np.linalg.norm(data[i] - data[4])) for i in range(len(data)) if i != 4}
    )
    with pytest.raises(ValueError):
        nb.distances(table(spark, data), [4], "cosine")


def test_zero_exact_sum_is_null(spark):
    vectors = table(spark, [[0, 0], [0, 0], [0, 0]])
    exact = nb.exact_knn(vectors, [0], 2)
    assert nb.ann_error(exact, exact).first()["error"] is None


def test_query_without_a_mate_counts_as_zero(spark):
    vectors = table(spark, [[0.0], [10.0], [11.0]])
    family = nb.HashFamily(((0,),), ((5.0,),))
    lsh, exact = nb.lsh_knn(vectors, family, [0, 1], 1), nb.exact_knn(vectors, [0, 1], 1)
    assert nb.ann_error(lsh, exact).first()["error"] == pytest.approx((0 + 1) / 2)


def test_sweep_equals_single_runs(spark, data):
    vectors, queries = table(spark, data), [0, 7, 20]
    families = {(k, L): nb.lsh_family(k, L, 12, seed=k + L) for k, L in ((4, 2), (6, 2), (4, 5))}
    swept = {(r["k"], r["L"]): r["error"] for r in nb.ann_sweep(vectors, families, queries, 3).collect()}
    exact = nb.exact_knn(vectors, queries, 3)
    single = {
        setting: nb.ann_error(nb.lsh_knn(vectors, family, queries, 3), exact).first()["error"]
        for setting, family in families.items()
    }
    assert swept == pytest.approx(single)


def test_many_queries_take_the_shuffle_path(spark, data, monkeypatch):
    family, queries = nb.lsh_family(k=5, L=3, dims=12, seed=5), list(range(0, 60, 7))
    few = rows(nb.lsh_knn(table(spark, data), family, queries, 4))
    monkeypatch.setattr(nb, "QUERIES_PER_PASS", 2)
    assert rows(nb.lsh_knn(table(spark, data), family, queries, 4)) == few


def test_hash_rows_with_any_functions(spark):
    def total(v):
        return F.aggregate(v, F.lit(0.0), lambda s, x: s + x)

    def squares(v):
        return F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)

    found = nb.hash_rows(table(spark, [[1, 2, 3], [4, 5, 6]]), [total, squares])
    assert rows(found) == [(0, [6.0, 14.0]), (1, [15.0, 77.0])]


def test_uneven_vectors_are_an_error():
    import pyarrow as pa

    from lodeworks.functions.vectors import matrix

    assert matrix(pa.array([[1.0, 2.0], [3.0, 4.0]])).tolist() == [[1.0, 2.0], [3.0, 4.0]]
    for rows in ([[1.0, 2.0, 3.0], [4.0]], [[1.0], None], [[None, 1.0], [2.0, 3.0]]):
        with pytest.raises(ValueError):
            matrix(pa.array(rows, pa.list_(pa.float64())))
