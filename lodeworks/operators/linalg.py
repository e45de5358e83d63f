"""Gram matrix, eigen-pairs and singular values of a tall table of vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.vectors import as_vectors, matrix
from lodeworks.operators.checkpoints import discard, scratch_path, store

# Random directions beyond those asked for, and the seed of all.
SPARE, SEED = 10, 17
# Power iterations at most, and the change of the values, relative to the first, that ends them.
PASSES, TOLERANCE = 40, 1e-12
# Tasks' matrices that one step of the tree combines.
FAN = 16


def gram_matrix(vectors: DataFrame, vector: str = "v") -> DataFrame:
    """`i, j, g`: the sum over all rows of v[i] * v[j].

    Each task adds up its own rows first, so only d * d numbers per task are
    shuffled, however many rows there are.
    """

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                points = matrix(batch.column(0))
                part = points.T @ points
                total = part if total is None else total + part
        if total is not None:
            d = len(total)
            i, j = np.divmod(np.arange(d * d, dtype=np.int32), d)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], names=["i", "j", "g"]
            )

    return (
        vectors.select(vector)
        .mapInArrow(partial, "i int, j int, g double")
        .groupBy("i", "j")
        .agg(F.sum("g").alias("g"))
    )


def _dims(vectors: DataFrame, vector: str) -> int:
    first = vectors.select(F.size(vector).alias("d")).first()
    return 0 if first is None else first["d"]


def _signed(columns: np.ndarray) -> np.ndarray:
    """Flip each column so that its largest component is positive."""
    largest = np.abs(columns).round(9).argmax(axis=0)
    return columns * np.where(columns[largest, np.arange(columns.shape[1])] < 0, -1.0, 1.0)


def _partials(vectors: DataFrame, vector: str, fold: Callable[[np.ndarray | None, np.ndarray], np.ndarray]) -> DataFrame:
    """`task, i, r`: the rows of the matrix into which each task folds its batches."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                held = fold(held, matrix(batch.column(0)))
        if held is not None:
            task = np.full(len(held), TaskContext.get().partitionId(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(task), pa.array(np.arange(len(held), dtype=np.int32)), as_vectors(held)], ["task", "i", "r"]
            )

    return vectors.select(vector).mapInArrow(scan, "task bigint, i int, r array<double>")


def _merged(partials: DataFrame, combine: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """All tasks' matrices combined in a tree, FAN at a time; the driver gets the last FAN at most."""
    spark = partials.sparkSession

    def matrices(rows: pa.Table) -> list[np.ndarray]:
        rows = rows.sort_by([("task", "ascending"), ("i", "ascending")]).combine_chunks()
        tasks = rows["task"].to_numpy()
        whole = matrix(rows["r"].chunk(0)) if len(tasks) else np.zeros((0, 0))
        return np.split(whole, np.flatnonzero(np.diff(tasks)) + 1) if len(tasks) else []

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        out = combine(matrices(rows))
        task = pa.array(np.full(len(out), key[0].as_py(), np.int64))
        return pa.table({"task": task, "i": pa.array(np.arange(len(out), dtype=np.int32)), "r": as_vectors(out)})

    path = scratch_path(spark, "partials")
    level = store(partials, path)
    while (level.agg(F.count_distinct("task")).first()[0]) > FAN:
        done, path = path, scratch_path(spark, "partials")
        above = level.groupBy(F.floor(F.col("task") / FAN).alias("above"))
        level = store(above.applyInArrow(merge, "task bigint, i int, r array<double>"), path)
        discard(spark, done)
    last = matrices(level.toArrow())
    discard(spark, path)
    return combine(last) if last else None


def _triangle(parts: list[np.ndarray]) -> np.ndarray:
    """R of the QR decomposition of some matrices on top of each other."""
    return np.linalg.qr(np.vstack(parts), mode="r")


def _singular(vectors: DataFrame, k: int | None, vector: str) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, descending, and right singular vectors as columns.

    A basis of k + SPARE random directions is turned towards the leading ones by power
    iterations, each a pass over the table, until the values stand still; with as many
    directions as dimensions any basis will do, and there is no such pass. The table's image in
    the basis is then reduced by QR, rows first, tasks in a tree, and its small triangle solved.
    """
    d = _dims(vectors, vector)
    k = d if k is None else min(k, d)
    width = min(d, k + SPARE)
    if not width:
        return np.zeros(0), np.zeros((0, 0))
    basis = np.eye(d)
    if width < d:
        basis = np.linalg.qr(np.random.default_rng(SEED).normal(size=(d, width)))[0]
        before = np.zeros(k)
        for _ in range(PASSES):

            def images(held: np.ndarray | None, rows: np.ndarray, basis: np.ndarray = basis) -> np.ndarray:
                part = (rows @ basis).T @ rows
                return part if held is None else held + part

            turned = _merged(_partials(vectors, vector, images), sum).T
            values = np.linalg.eigvalsh(basis.T @ turned)[::-1][:k]
            basis = np.linalg.qr(turned)[0]
            if np.abs(values - before).max() <= TOLERANCE * max(values[0], 0.0):
                break
            before = values

    def reduced(held: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
        return _triangle([rows @ basis] if held is None else [held, rows @ basis])

    small = _merged(_partials(vectors, vector, reduced), _triangle)
    padded = np.zeros((width, width))
    padded[: len(small)] = small
    _, sigma, turns = np.linalg.svd(padded)
    return sigma[:k], _signed((basis @ turns.T)[:, :k])


def eigen_sym(vectors: DataFrame, k: int | None = None, vector: str = "v") -> DataFrame:
    """`rank, eigenvalue, vector`: the k leading eigen-pairs of the Gram matrix, largest first.

    The Gram matrix itself is not made, so the width is bounded by k vectors in a task only.
    """
    sigma, columns = _singular(vectors, k, vector)
    return vectors.sparkSession.createDataFrame(
        [(r + 1, float(x * x), columns[:, r].tolist()) for r, x in enumerate(sigma)],
        "rank int, eigenvalue double, vector array<double>",
    )


def svd(vectors: DataFrame, k: int | None = None, vector: str = "v") -> DataFrame:
    """`rank, sigma, v`: the k leading singular values, largest first, and right singular vectors."""
    sigma, columns = _singular(vectors, k, vector)
    return vectors.sparkSession.createDataFrame(
        [(r + 1, float(x), columns[:, r].tolist()) for r, x in enumerate(sigma)],
        "rank int, sigma double, v array<double>",
    )


def svd_project(vectors: DataFrame, decomposition: DataFrame, id: str = "id", vector: str = "v") -> DataFrame:
    """`id, u`: left singular vectors, one row of U per input row.

    `decomposition` is the result of `svd`, at most d rows. A direction with
    singular value 0 gets u = 0.
    """
    parts = sorted(decomposition.collect(), key=lambda r: r["rank"])
    sigma = np.array([p["sigma"] for p in parts])
    usable = sigma > 1e-12 * max(sigma.max(initial=0.0), 1e-300)
    scale = np.where(usable, 1.0 / np.where(usable, sigma, 1.0), 0.0)
    basis = np.array([p["v"] for p in parts]).T * scale

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), as_vectors(matrix(batch.column(1)) @ basis)], names=["id", "u"]
                )

    return vectors.select(F.col(id).cast("bigint").alias("id"), F.col(vector).alias("v")).mapInArrow(
        project, "id bigint, u array<double>"
    )
