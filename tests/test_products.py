import numpy as np
import pytest

from lodeworks.operators import cf, products


def table(spark, X, shift=0):
    return spark.createDataFrame([(int(i) + shift, int(j), float(X[i, j])) for i, j in zip(*np.nonzero(X))], "m bigint, at bigint, w double")


@pytest.mark.parametrize("gain", [1e9, 1e-9])
def test_blocks_add_up_to_the_whole_product(spark, monkeypatch, gain):
    """Blocks of three members or seven cells; by dense factors and by cells, a few products at a time."""
    for name, value in (("WIDTH", 3), ("BLOCK_CELLS", 7), ("CHUNK", 5), ("INNER", 2), ("DENSE_GAIN", gain)):
        monkeypatch.setattr(products, name, value)
    draw = np.random.default_rng(1)
    A, B = draw.integers(-2, 3, (11, 6)) * (draw.random((11, 6)) < 0.5), draw.integers(0, 3, (7, 6))
    A[4] = 1
    made = {(r["a"], r["b"]): r["s"] for r in products.products(table(spark, A), table(spark, B, 100)).collect()}
    want = A @ B.T
    assert made == pytest.approx({(int(i), int(j) + 100): float(want[i, j]) for i, j in zip(*np.nonzero(want))})


def test_many_items_make_sums_inside_tasks(spark, monkeypatch):
    """Beyond MAX_DENSE what is shuffled after the cells are sums of blocks: the best items alone leave a task."""
    monkeypatch.setattr(cf, "MAX_DENSE", 0)
    left = []
    made = cf.products
    monkeypatch.setattr(cf, "products", lambda *args, **more: left.append(made(*args, **more)) or left[-1])
    draw = np.random.default_rng(2)
    R = (draw.random((12, 40)) < 0.4).astype(int)
    seen = table(spark, R).toDF("user", "item", "r")
    best = cf.cf_top_n(cf.cf_scores_item(seen, top=2, unseen=True), 2, seen=seen)
    got = {(r["user"], r["rank"]): (r["item"], r["score"]) for r in best.collect()}
    plain = cf.cf_top_n(cf.cf_scores_item(seen), 2, seen=seen)
    assert got == {(r["user"], r["rank"]): (r["item"], r["score"]) for r in plain.collect()}
    assert left[1].count() < 12 * 4


def test_a_side_with_few_cells_has_wide_blocks(spark, monkeypatch):
    """Cells are sent once for each block of the other side, so the side with many cells meets few blocks."""
    monkeypatch.setattr(products, "WIDTH", 4)
    draw = np.random.default_rng(3)
    A, B = np.eye(16)[draw.integers(0, 16, 48)], draw.integers(1, 3, (16, 16))
    blocks, made = [], products._blocks
    monkeypatch.setattr(products, "_blocks", lambda *args: blocks.append(made(*args)) or blocks[-1])
    sums = {(r["a"], r["b"]): r["s"] for r in products.products(table(spark, A), table(spark, B)).collect()}
    want = A @ B.T
    assert sums == pytest.approx({(int(i), int(j)): float(want[i, j]) for i, j in zip(*np.nonzero(want))})
    left, right = (b.select("block").distinct().count() for b in blocks)
    assert 48 * right + 256 * left < 48 * 4 + 256 * 12


def test_a_table_by_itself_is_packed_once_and_without_ids(spark, monkeypatch):
    """A cell is its place in the block and its weight; the ids of a block are sent once."""
    packed, made = [], products._packed
    monkeypatch.setattr(products, "_packed", lambda *args: packed.append(made(*args)) or packed[-1])
    monkeypatch.setattr(products, "WIDTH", 3)
    A = np.random.default_rng(4).integers(0, 3, (10, 6))
    cells = table(spark, A, 2**40)
    sums = {(r["a"] - 2**40, r["b"] - 2**40): r["s"] for r in products.products(cells, cells, symmetric=True).collect()}
    want = np.triu(A @ A.T)
    assert sums == pytest.approx({(int(i), int(j)): float(want[i, j]) for i, j in zip(*np.nonzero(want))})
    assert len(packed) == 1
    assert dict(packed[0].dtypes) == {"block": "bigint", "at": "bigint", "places": "array<smallint>", "ws": "array<double>"}
