"""k-means from given centroids under L1 or L2, with the cost of every iteration."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.functions.vectors import check_metric, gaps, matrix
from lodeworks.operators.checkpoints import discard, scratch_path, store

# Centroid coordinates that a driver and every task may hold.
MAX_CENTROID_CELLS = 20_000_000

Centroids = dict[int, np.ndarray]


def _on_driver(centroids: DataFrame | Mapping[int, Sequence[float]]) -> Centroids:
    """The k centroids by id; k * d is checked, it does not grow with the data."""
    if isinstance(centroids, DataFrame):
        k = centroids.count()
        width = centroids.select(F.max(F.size("c"))).first()[0] or 0
        if k * width > MAX_CENTROID_CELLS:
            raise ValueError(f"{k} centroids of {width} dimensions are too many to copy to every task")
        centroids = {r["cid"]: r["c"] for r in centroids.select("cid", "c").collect()}
    return {int(cid): np.asarray(centroids[cid], dtype=float) for cid in sorted(centroids)}


def _nearest(points: np.ndarray, centroids: Centroids, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Position of the nearest centroid (the first of equals), and its distance."""
    best = np.full(len(points), np.inf)
    which = np.zeros(len(points), dtype=np.int64)
    for position, center in enumerate(centroids.values()):
        dist = gaps(points, center, metric)
        closer = dist < best
        which[closer] = position
        best[closer] = dist[closer]
    return which, best


def _cost(dist: np.ndarray, metric: str) -> np.ndarray:
    return dist * dist if metric == "l2" else dist


def kmeans_assign(
    points: DataFrame,
    centroids: DataFrame | Mapping[int, Sequence[float]],
    metric: str = "l2",
    id: str = "id",
    vector: str = "v",
) -> DataFrame:
    """`id, cid, cost, v`: the nearest centroid of each point, the lower id on a tie.

    The cost is the distance under L1 and its square under L2.
    """
    check_metric(metric)
    fixed = _on_driver(centroids)
    cids = np.array(list(fixed), dtype=np.int32)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                which, dist = _nearest(matrix(batch.column(1)), fixed, metric)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(cids[which]), pa.array(_cost(dist, metric)), batch.column(1)],
                    names=["id", "cid", "cost", "v"],
                )

    return points.select(F.col(id).cast("bigint").alias("id"), F.col(vector).alias("v")).mapInArrow(
        assign, "id bigint, cid int, cost double, v array<double>"
    )


def kmeans_update(assigned: DataFrame) -> DataFrame:
    """`cid, c, n, cost`: mean, size and cost of each cluster; empty ones vanish."""
    return assigned.groupBy("cid").agg(
        vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("c"),
        F.count(F.lit(1)).alias("n"),
        F.sum("cost").alias("cost"),
    )


def _iterate(points: DataFrame, runs: dict[tuple[str, str], Centroids]) -> dict[tuple[str, str], tuple[Centroids, float]]:
    """One step of every run in one pass over the points.

    A task sends one row per run and cluster: coordinate sums, count and cost.
    """
    names = list(runs)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            data = matrix(batch.column(0))
            for run, name in enumerate(names):
                which, dist = _nearest(data, runs[name], name[0])
                cost = _cost(dist, name[0])
                for position, cid in enumerate(runs[name]):
                    mine = which == position
                    if mine.any():
                        part = np.concatenate([data[mine].sum(axis=0), [mine.sum(), cost[mine].sum()]])
                        sums[run, cid] = sums[run, cid] + part if (run, cid) in sums else part
        if sums:
            keys = np.array(list(sums), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([s.tolist() for s in sums.values()])],
                names=["run", "cid", "parts"],
            )

    totals = (
        points.mapInArrow(partial, "run int, cid int, parts array<double>")
        .select("run", "cid", F.posexplode("parts").alias("slot", "x"))
        .groupBy("run", "cid", "slot")
        .agg(F.sum("x").alias("x"))
    )
    cells: dict[tuple[int, int], dict[int, float]] = {}
    for row in totals.collect():
        cells.setdefault((row["run"], row["cid"]), {})[row["slot"]] = row["x"]
    moved: dict[tuple[str, str], tuple[Centroids, float]] = {}
    for run, name in enumerate(names):
        centers, cost = {}, 0.0
        for cid in runs[name]:
            if (run, cid) in cells:
                parts = np.array([x for _, x in sorted(cells[run, cid].items())])
                centers[cid] = parts[:-2] / parts[-2]
                cost += parts[-1]
        moved[name] = centers, cost
    return moved


def kmeans_fit(
    points: DataFrame,
    inits: Mapping[str, DataFrame | Mapping[int, Sequence[float]]],
    metrics: Sequence[str] = ("l2", "l1"),
    iters: int = 20,
    vector: str = "v",
) -> tuple[DataFrame, DataFrame]:
    """Fixed-length k-means for each metric and each named set of first centroids.

    Returns `metric, init, cid, c` (the last centroids) and the cost trace
    `metric, init, iteration, cost, pct_of_first`. The cost of an iteration is
    measured against the centroids that enter it; all metrics move a centroid to
    the mean. All runs share one pass over the points per iteration, and only
    k * d numbers per run come back to the driver. The vectors are stored once, as the
    input may be dear to make, and deleted when the last iteration is done.
    """
    for metric in metrics:
        check_metric(metric)
    runs = {(metric, name): _on_driver(first) for metric in metrics for name, first in inits.items()}
    path = scratch_path(points.sparkSession, "points")
    kept = store(points.select(F.col(vector).alias("v")), path)
    trace = []
    try:
        for iteration in range(1, iters + 1):
            moved = _iterate(kept, runs)
            runs = {name: centers for name, (centers, _) in moved.items()}
            trace += [(*name, iteration, float(cost)) for name, (_, cost) in moved.items()]
    finally:
        discard(points.sparkSession, path)
    spark = points.sparkSession
    centroids = spark.createDataFrame(
        [(*name, cid, c.tolist()) for name, centers in runs.items() for cid, c in centers.items()],
        "metric string, init string, cid int, c array<double>",
    )
    costs = spark.createDataFrame(trace, "metric string, init string, iteration int, cost double")
    by_iteration = Window.partitionBy("metric", "init").orderBy("iteration")
    first_cost = F.first("cost").over(by_iteration)
    return centroids, costs.withColumn("pct_of_first", 100 * F.col("cost") / first_cost)


def cost_drop(trace: DataFrame, iteration: int = 10) -> DataFrame:
    """`metric, init, pct_of_first, pct_dropped` once `iteration` costs are known."""
    return trace.where(F.col("iteration") == iteration).select(
        "metric", "init", "pct_of_first", (100 - F.col("pct_of_first")).alias("pct_dropped")
    )
