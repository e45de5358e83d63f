import numpy as np
import pytest

from lodeworks.operators import linalg

M = [[1.0, 2.0], [2.0, 1.0], [3.0, 4.0], [4.0, 3.0]]


def table(spark, data):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id bigint, v array<double>")


def test_gram_of_the_small_matrix(spark):
    found = {(r["i"], r["j"]): r["g"] for r in linalg.gram_matrix(table(spark, M)).collect()}
    assert found == {(0, 0): 30, (0, 1): 28, (1, 0): 28, (1, 1): 30}


def test_eigen_pairs_descend(spark):
    pairs = linalg.eigen_sym(table(spark, M)).orderBy("rank").collect()
    assert [p["eigenvalue"] for p in pairs] == pytest.approx([58, 2])
    assert np.abs([p["vector"] for p in pairs]) == pytest.approx(np.full((2, 2), 0.70710678), abs=1e-8)
    assert all(max(p["vector"], key=lambda x: abs(round(x, 9))) > 0 for p in pairs)  # the first of equal ones


@pytest.mark.parametrize("fan", [16, 2])
def test_singular_values(spark, monkeypatch, fan):
    monkeypatch.setattr(linalg, "FAN", fan)
    parts = linalg.svd(table(spark, M).repartition(4)).orderBy("rank").collect()
    assert [p["sigma"] for p in parts] == pytest.approx([7.61577311, 1.41421356], abs=1e-7)


def test_projection_rebuilds_the_table(spark):
    data = np.random.default_rng(0).normal(size=(50, 6))
    vectors = table(spark, data).repartition(3)
    parts = linalg.svd(vectors)
    u = {r["id"]: r["u"] for r in linalg.svd_project(vectors, parts).collect()}
    ordered = parts.orderBy("rank").collect()
    sigma, v = np.diag([p["sigma"] for p in ordered]), np.array([p["v"] for p in ordered])
    U = np.array([u[i] for i in range(50)])
    assert U @ sigma @ v == pytest.approx(data)
    assert U.T @ U == pytest.approx(np.eye(6), abs=1e-9)
    assert np.abs(np.diag(sigma)) == pytest.approx(np.linalg.svd(data, compute_uv=False))


def test_rank_deficient_direction_is_zero(spark):
    vectors = table(spark, [[1, 1], [2, 2], [3, 3]])
    u = linalg.svd_project(vectors, linalg.svd(vectors)).collect()
    assert all(abs(r["u"][1]) < 1e-6 for r in u)


def leading(data, k):
    _, sigma, v = np.linalg.svd(data, full_matrices=False)
    return sigma[:k], v[:k]


@pytest.mark.parametrize("rows, dims, k, fan", [(40, 5000, 5, 16), (300, 60, 4, 2), (300, 60, 60, 3), (300, 60, None, 16), (5, 12, 3, 2)])
def test_one_way_for_any_width(spark, monkeypatch, rows, dims, k, fan):
    monkeypatch.setattr(linalg, "FAN", fan)
    draw = np.random.default_rng(dims)
    data = draw.normal(size=(rows, dims)) * 0.1
    for strength in (9, 7, 5, 3, 2):
        data += strength * np.outer(draw.normal(size=rows), draw.normal(size=dims)) / np.sqrt(dims)
    parts = linalg.svd(table(spark, data).repartition(7), k).orderBy("rank").collect()
    found = min(k or dims, dims)
    assert len(parts) == found
    sigma, v = leading(data, found)
    assert np.array([p["sigma"] for p in parts])[: len(sigma)] == pytest.approx(sigma, rel=1e-9, abs=1e-9)
    some = min(4, len(sigma))
    assert np.abs(np.array([p["v"] for p in parts[:some]]) @ v[:some].T) == pytest.approx(np.eye(some), abs=1e-6)
    V = np.array([p["v"] for p in parts])
    assert V @ V.T == pytest.approx(np.eye(found), abs=1e-9)


def test_small_values_keep_their_digits(spark):
    # The Gram matrix of these would lose the second value: its square is below a double's last digit.
    parts = linalg.svd(table(spark, [[1, 1], [1e-9, 0], [0, 1e-9]])).orderBy("rank").collect()
    assert parts[1]["sigma"] == pytest.approx(np.linalg.svd([[1, 1], [1e-9, 0], [0, 1e-9]], compute_uv=False)[1], rel=1e-6)


def test_deficient_and_empty_tables(spark):
    same_rows = table(spark, [[1, 2, 3]] * 6).repartition(3)
    for k in (None, 2):
        parts = linalg.eigen_sym(same_rows, k).orderBy("rank").collect()
        assert [p["eigenvalue"] for p in parts] == pytest.approx([84, 0, 0][: k or 3], abs=1e-9)
        vectors = np.array([p["vector"] for p in parts])
        assert vectors @ vectors.T == pytest.approx(np.eye(len(parts)), abs=1e-9)
    empty = table(spark, [[1.0]]).where("id < 0")
    assert linalg.svd(empty).count() == 0 and linalg.eigen_sym(empty, 3).count() == 0
