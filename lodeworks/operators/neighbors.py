"""Nearest neighbours: bit-threshold hashing, exact search, and the error between them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.functions.vectors import check_metric, distance, gaps, matrix

# Queries compared with the table in one pass over it. More queries take more
# passes, so the copy that each task holds stays bounded.
QUERIES_PER_PASS = 1024


@dataclass(frozen=True)
class HashFamily:
    """L tables of k bits; bit b of table t is `v[dims[t][b]] >= thresholds[t][b]`."""

    dims: tuple[tuple[int, ...], ...]
    thresholds: tuple[tuple[float, ...], ...]

    @property
    def tables(self) -> int:
        return len(self.dims)

    @property
    def bits(self) -> int:
        return len(self.dims[0])

    def rows(self) -> list[tuple[int, int, int, float]]:
        """`(tbl, bit, dim, thr)`, the family as a table."""
        return [
            (t, b, d, x)
            for t, (dims, cuts) in enumerate(zip(self.dims, self.thresholds))
            for b, (d, x) in enumerate(zip(dims, cuts))
        ]


def lsh_family(
    k: int = 24,
    L: int = 10,
    dims: int = 400,
    lo: float = 0,
    hi: float = 255,
    seed: int = 0,
) -> HashFamily:
    """Draw dimensions with replacement and thresholds in [lo, hi].

    Integer bounds give integer thresholds, both ends included; float bounds
    give real ones.
    """
    random = np.random.default_rng(seed)
    chosen = random.integers(0, dims, size=(L, k))
    if isinstance(lo, int) and isinstance(hi, int):
        cuts = random.integers(lo, hi, size=(L, k), endpoint=True).astype(float)
    else:
        cuts = random.uniform(lo, hi, size=(L, k))
    return HashFamily(
        tuple(tuple(int(d) for d in row) for row in chosen),
        tuple(tuple(float(x) for x in row) for row in cuts),
    )


def bucket_keys(points: np.ndarray, family: HashFamily) -> np.ndarray:
    """The k-character keys of a batch of vectors as (rows, L) byte strings."""
    bits = points[:, np.array(family.dims)] >= np.array(family.thresholds)
    return np.ascontiguousarray(bits.astype(np.uint8) + ord("0")).view(f"S{family.bits}")[..., 0]


def _strings(keys: np.ndarray) -> pa.StringArray:
    """Byte strings of one length as an Arrow column."""
    flat = np.ascontiguousarray(keys).ravel()
    ends = np.arange(0, (len(flat) + 1) * flat.itemsize, flat.itemsize, dtype=np.int32)
    return pa.StringArray.from_buffers(len(flat), pa.py_buffer(ends), pa.py_buffer(flat.tobytes()))


def hash_rows(
    vectors: DataFrame, functions: Sequence[Callable[[Column], Column]], id: str = "id", vector: str = "v"
) -> DataFrame:
    """`id, keys`: the array of what each function makes of the vector."""
    return vectors.select(F.col(id).alias("id"), F.array(*[f(F.col(vector)) for f in functions]).alias("keys"))


def _id_and_vector(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    return vectors.select(F.col(id).cast("bigint").alias("id"), F.col(vector).alias("v"))


def lsh_signatures(vectors: DataFrame, family: HashFamily, id: str = "id", vector: str = "v") -> DataFrame:
    """`id, tbl, key`: the bucket of every vector in every table."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), family.tables)
                tables = np.tile(np.arange(family.tables, dtype=np.int32), batch.num_rows)
                keys = _strings(bucket_keys(matrix(batch.column(1)), family))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(tables), keys], names=["id", "tbl", "key"])

    return _id_and_vector(vectors, id, vector).mapInArrow(sign, "id bigint, tbl int, key string")


def _first_shared_table(mine: str, theirs: str) -> Column:
    """1-based number of the first table in which two key arrays agree."""
    return F.array_position(F.zip_with(mine, theirs, lambda a, b: a == b), F.lit(True))


def _pair_once(hashed: DataFrame, queries: DataFrame, by: list[str]) -> DataFrame:
    """Rows that share a bucket, each (query, row) pair once.

    `hashed` has `id, keys`, `queries` has `query_id, query_keys`. Both sides are
    exploded to buckets; a pair that meets in several tables is kept only at the
    first, so no distinct is needed.
    """
    left = hashed.select("*", F.posexplode("keys").alias("tbl", "key"))
    right = queries.select("*", F.posexplode("query_keys").alias("tbl", "key"))
    return left.join(right, [*by, "tbl", "key"]).where(
        (F.col("id") != F.col("query_id"))
        & (_first_shared_table("keys", "query_keys") == F.col("tbl") + 1)
    )


def lsh_candidates(signatures: DataFrame, query_ids: Sequence[int]) -> DataFrame:
    """`query_id, id`: who shares at least one bucket with each query.

    The buckets of the named queries are few and may be broadcast, so the signatures
    are not shuffled and a hot bucket stays spread over its scan tasks.
    """
    queries = signatures.where(F.col("id").isin(list(query_ids))).select(
        F.col("id").alias("query_id"), "tbl", "key"
    )
    if len(query_ids) <= QUERIES_PER_PASS:
        queries = F.broadcast(queries)
    return (
        signatures.join(queries, ["tbl", "key"])
        .where(F.col("id") != F.col("query_id"))
        .select("query_id", "id")
        .distinct()
    )


def _n_nearest(found: DataFrame, n: int, groups: Sequence[str] = ("query_id",)) -> DataFrame:
    """The n rows with the smallest (dist, id) of each group, as `rank` 1..n."""
    nearest_first = Window.partitionBy(*groups).orderBy("dist", "id")
    return found.withColumn("rank", F.row_number().over(nearest_first).cast("bigint")).where(F.col("rank") <= n)


def _key_arrays(vectors: DataFrame, families: dict[tuple[int, int], HashFamily], id: str, vector: str) -> DataFrame:
    """`k, L, id, keys`: the keys of every vector as one array per family."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (k, L), family in families.items() if batch.num_rows else ():
                keys = _strings(bucket_keys(matrix(batch.column(1)), family))
                ends = np.arange(0, len(keys) + 1, family.tables, dtype=np.int32)
                setting = [pa.array(np.full(batch.num_rows, x, dtype=np.int32)) for x in (k, L)]
                yield pa.RecordBatch.from_arrays(
                    [*setting, batch.column(0), pa.ListArray.from_arrays(pa.array(ends), keys)],
                    names=["k", "L", "id", "keys"],
                )

    return _id_and_vector(vectors, id, vector).mapInArrow(sign, "k int, L int, id bigint, keys array<string>")


def _mates(keys: np.ndarray, query_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, query) positions that share a bucket in any table, each pair once."""
    found = []
    for table in range(keys.shape[1]):
        order = np.argsort(query_keys[:, table], kind="stable")
        buckets = query_keys[order, table]
        first = np.searchsorted(buckets, keys[:, table], "left")
        many = np.searchsorted(buckets, keys[:, table], "right") - first
        row = np.repeat(np.arange(len(keys)), many)
        step = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        found.append(row * len(query_keys) + order[np.repeat(first, many) + step])
    return np.divmod(np.unique(np.concatenate(found)), len(query_keys))


def _lsh_scan(
    vectors: DataFrame,
    families: dict[tuple[int, int], HashFamily],
    block: tuple[np.ndarray, np.ndarray],
    metric: str,
    n: int,
    id: str,
    vector: str,
) -> DataFrame:
    """`k, L, query_id, id, dist` for one block of queries, n per task, family and query.

    The query keys travel to the tasks. Vectors are hashed, compared and dropped
    where they are scanned, so a hot bucket costs no shuffle.
    """
    query_ids, targets = block
    query_keys = {setting: bucket_keys(targets, family) for setting, family in families.items()}

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, points = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch.column(1))
            for (k, L), family in families.items():
                rows, asked = _mates(bucket_keys(points, family), query_keys[k, L])
                for at in np.unique(asked):
                    query = int(query_ids[at])
                    mine = rows[asked == at]
                    mine = mine[ids[mine] != query]
                    near, far = ids[mine], gaps(points[mine], targets[at], metric)
                    if (k, L, query) in kept:
                        near = np.concatenate([kept[k, L, query][0], near])
                        far = np.concatenate([kept[k, L, query][1], far])
                    best = _smallest(near, far, n)
                    kept[k, L, query] = near[best], far[best]
        for (k, L, query), (near, far) in kept.items():
            fixed = [np.full(len(near), x, dtype=t) for x, t in ((k, np.int32), (L, np.int32), (query, np.int64))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (*fixed, near, far)], names=["k", "L", "query_id", "id", "dist"]
            )

    return _id_and_vector(vectors, id, vector).mapInArrow(
        search, "k int, L int, query_id bigint, id bigint, dist double"
    )


def _lsh_found(
    vectors: DataFrame,
    families: dict[tuple[int, int], HashFamily],
    query_ids: Sequence[int],
    n: int,
    metric: str,
    id: str,
    vector: str,
) -> DataFrame:
    """`k, L, query_id, id, dist` of bucket mates, for several families in one scan.

    At least the n nearest of each query and family are among them.
    """
    check_metric(metric)
    if len(query_ids) <= QUERIES_PER_PASS:
        for block in _query_blocks(vectors, query_ids, id, vector):
            return _lsh_scan(vectors, families, block, metric, n, id, vector)
    # Shuffle by bucket without the vectors, and fetch those of the pairs found.
    hashed = _key_arrays(vectors, families, id, vector)
    asked = vectors.where(F.col(id).isin([int(q) for q in query_ids]))
    queries = _key_arrays(asked, families, id, vector).select(
        "k", "L", F.col("id").alias("query_id"), F.col("keys").alias("query_keys")
    )
    pairs = _pair_once(hashed, queries, ["k", "L"]).select("k", "L", "query_id", "id")
    return pair_distances(pairs, _id_and_vector(vectors, id, vector), metric)


def lsh_knn(
    vectors: DataFrame,
    family: HashFamily,
    query_ids: Sequence[int],
    n: int = 10,
    metric: str = "l1",
    id: str = "id",
    vector: str = "v",
) -> DataFrame:
    """`query_id, id, dist, rank`: the n nearest of each query's bucket mates."""
    found = _lsh_found(vectors, {(family.bits, family.tables): family}, query_ids, n, metric, id, vector)
    return _n_nearest(found.select("query_id", "id", "dist"), n)


def _query_blocks(
    vectors: DataFrame, query_ids: Sequence[int], id: str, vector: str
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The query vectors on the driver, at most QUERIES_PER_PASS at a time."""
    wanted = [int(q) for q in query_ids]
    for start in range(0, len(wanted), QUERIES_PER_PASS):
        part = wanted[start : start + QUERIES_PER_PASS]
        rows = (
            vectors.where(F.col(id).isin(part))
            .select(F.col(id).cast("bigint").alias("id"), F.col(vector).alias("v"))
            .collect()
        )
        rows.sort(key=lambda r: r["id"])
        if rows:
            yield np.array([r["id"] for r in rows]), np.array([r["v"] for r in rows], dtype=float)


def _smallest(ids: np.ndarray, dist: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n smallest (dist, id)."""
    if len(dist) > n:
        near = np.flatnonzero(dist <= np.partition(dist, n - 1)[n - 1])
    else:
        near = np.arange(len(dist))
    return near[np.lexsort((ids[near], dist[near]))][:n]


def _scan(vectors: DataFrame, block: tuple[np.ndarray, np.ndarray], metric: str, n: int | None, id: str, vector: str):
    """`query_id, id, dist` of one block of queries against the whole table.

    With `n`, each task returns only its n nearest per query.
    """
    query_ids, targets = block

    def emit(query: int, ids: np.ndarray, dist: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ids), query, dtype=np.int64)), pa.array(ids), pa.array(dist)],
            names=["query_id", "id", "dist"],
        )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            points = matrix(batch.column(1))
            for query, target in zip(query_ids.tolist(), targets):
                dist = gaps(points, target, metric)
                other = ids != query
                near, far = ids[other], dist[other]
                if n is None:
                    yield emit(query, near, far)
                    continue
                if query in kept:
                    near = np.concatenate([kept[query][0], near])
                    far = np.concatenate([kept[query][1], far])
                best = _smallest(near, far, n)
                kept[query] = near[best], far[best]
        for query, (near, far) in kept.items():
            yield emit(query, near, far)

    return _id_and_vector(vectors, id, vector).mapInArrow(
        compare, "query_id bigint, id bigint, dist double"
    )


def _scans(vectors: DataFrame, query_ids: Sequence[int], metric: str, n: int | None, id: str, vector: str) -> DataFrame:
    check_metric(metric)
    found: DataFrame | None = None
    for block in _query_blocks(vectors, query_ids, id, vector):
        part = _scan(vectors, block, metric, n, id, vector)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, id bigint, dist double")
    return found


def distances(
    vectors: DataFrame,
    query_ids: Sequence[int],
    metric: str = "l1",
    id: str = "id",
    vector: str = "v",
) -> DataFrame:
    """`query_id, id, dist` of every vector to every named query but itself."""
    return _scans(vectors, query_ids, metric, None, id, vector)


def pair_distances(
    pairs: DataFrame,
    vectors: DataFrame,
    metric: str = "l1",
    left: str = "query_id",
    right: str = "id",
    id: str = "id",
    vector: str = "v",
) -> DataFrame:
    """The given pairs with `dist`, the distance of their two vectors."""
    a = vectors.select(F.col(id).alias(left), F.col(vector).alias("_a"))
    b = vectors.select(F.col(id).alias(right), F.col(vector).alias("_b"))
    return pairs.join(a, left).join(b, right).select(*pairs.columns, distance("_a", "_b", metric).alias("dist"))


def exact_knn(
    vectors: DataFrame,
    query_ids: Sequence[int],
    n: int = 10,
    metric: str = "l1",
    id: str = "id",
    vector: str = "v",
) -> DataFrame:
    """`query_id, id, dist, rank` by comparing every vector; ties go to the lower id."""
    return _n_nearest(_scans(vectors, query_ids, metric, n, id, vector), n)


def ann_ratios(lsh: DataFrame, exact: DataFrame, settings: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """`query_id, n_found, ratio`: distance sums found / exact, per query.

    A query for which fewer neighbours were found has fewer terms above the line,
    and 0 if none was found. An exact sum of zero gives NULL. With `settings`,
    `lsh` has columns k and L and the result one row per setting and query.
    """
    groups = [] if settings is None else ["k", "L"]
    best = exact.groupBy("query_id").agg(F.sum("dist").alias("best"))
    if settings is not None:
        tried = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(L).alias("L")) for k, L in settings])
        best = best.select("query_id", "best", F.explode(tried).alias("s")).select("query_id", "best", "s.*")
    near = lsh.groupBy(*groups, "query_id").agg(F.sum("dist").alias("near"), F.count(F.lit(1)).alias("n_found"))
    return best.join(near, [*groups, "query_id"], "left").select(
        *groups,
        "query_id",
        F.coalesce("n_found", F.lit(0)).cast("bigint").alias("n_found"),
        F.when(F.col("best") != 0, F.coalesce("near", F.lit(0.0)) / F.col("best")).alias("ratio"),
    )


def ann_error(lsh: DataFrame, exact: DataFrame) -> DataFrame:
    """`error, n_found`: mean ratio over all queries, and neighbours found in all."""
    return ann_ratios(lsh, exact).agg(F.avg("ratio").alias("error"), F.sum("n_found").alias("n_found"))


def ann_sweep(
    vectors: DataFrame,
    families: dict[tuple[int, int], HashFamily],
    query_ids: Sequence[int],
    n: int = 3,
    metric: str = "l1",
    id: str = "id",
    vector: str = "v",
) -> DataFrame:
    """`k, L, error, n_found` for each family, keyed by its (k, L).

    All settings are hashed in one scan of the vectors; the exact neighbours are
    found once, in another.
    """
    found = _lsh_found(vectors, families, query_ids, n, metric, id, vector)
    lsh = _n_nearest(found, n, ("k", "L", "query_id"))
    exact = exact_knn(vectors, query_ids, n, metric, id, vector)
    return (
        ann_ratios(lsh, exact, list(families))
        .groupBy("k", "L")
        .agg(F.avg("ratio").alias("error"), F.sum("n_found").alias("n_found"))
    )
