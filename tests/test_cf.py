import numpy as np
import pytest

from lodeworks.operators import cf


@pytest.fixture
def matrix():
    R = (np.random.default_rng(6).random((30, 11)) < 0.35).astype(float)
    R[7] = 1  # a user who saw everything
    R[3] = 0  # and one who saw nothing
    R[:, 10] = 0  # and an item nobody saw
    return R


def sparse(spark, R):
    cells = [(int(u), int(i), int(R[u, i])) for u in range(R.shape[0]) for i in range(R.shape[1])]
    return spark.createDataFrame(cells, "user bigint, item bigint, r bigint")


def dense(frame, shape, names):
    out = np.zeros(shape)
    for r in frame.collect():
        out[r[names[0]], r[names[1]]] = r[names[2]]
    return out


def brute(R):
    du, di = R.sum(1), R.sum(0)
    pu = np.divide(1, np.sqrt(np.maximum(du, 0)), out=np.zeros_like(du), where=du > 0)
    qi = np.divide(1, np.sqrt(np.maximum(di, 0)), out=np.zeros_like(di), where=di > 0)
    Su, Si = pu[:, None] * (R @ R.T) * pu, qi[:, None] * (R.T @ R) * qi
    return Su, Si, Su @ R, R @ Si


@pytest.mark.parametrize("max_dense", [2000, 0])
def test_against_dense_algebra(spark, matrix, monkeypatch, max_dense):
    monkeypatch.setattr(cf, "MAX_DENSE", max_dense)
    Su, Si, Yu, Yi = brute(matrix)
    seen = sparse(spark, matrix)
    assert dense(cf.item_similarity(seen, block_rows=4), Si.shape, "i j sim".split()) == pytest.approx(Si)
    assert dense(cf.user_similarity(seen, block_rows=4), Su.shape, "u v sim".split()) == pytest.approx(Su)
    half = dense(cf.user_similarity(seen, mirror=False), Su.shape, "u v sim".split())
    assert half == pytest.approx(np.triu(Su))
    names = "user item score".split()
    assert dense(cf.cf_scores_item(seen, block_rows=4), Yi.shape, names) == pytest.approx(Yi)
    assert dense(cf.cf_scores_user(seen, block_rows=4), Yu.shape, names) == pytest.approx(Yu)
    some = cf.cf_scores_user(seen, users=[7, 12])
    assert {r["user"] for r in some.collect()} <= {7, 12}
    assert dense(some, Yu.shape, names)[[7, 12]] == pytest.approx(Yu[[7, 12]])


@pytest.mark.parametrize("max_dense", [2000, 0])
def test_values_other_than_one(spark, matrix, monkeypatch, max_dense):
    monkeypatch.setattr(cf, "MAX_DENSE", max_dense)
    R = matrix * np.random.default_rng(1).integers(1, 4, matrix.shape)
    Su, Si, Yu, Yi = brute(R)
    seen = sparse(spark, R)
    assert dense(cf.item_similarity(seen), Si.shape, "i j sim".split()) == pytest.approx(Si)
    assert dense(cf.cf_scores_user(seen), Yu.shape, "user item score".split()) == pytest.approx(Yu)


def test_degrees_skip_zero_cells(spark, matrix):
    seen = sparse(spark, matrix)
    users = {r["user"]: r["d"] for r in cf.user_degree(seen).collect()}
    assert 3 not in users and users[7] == matrix[7].sum()
    items = {r["item"]: r["d"] for r in cf.item_degree(seen).collect()}
    assert 10 not in items and items[0] == matrix[:, 0].sum()


def test_top_n_ties_filters_and_seen_items(spark):
    scores = spark.createDataFrame(
        [(1, 5, 0.5), (1, 2, 0.5 + 1e-13), (1, 9, 0.9), (1, 120, 2.0), (2, 1, 0.1)],
        "user bigint, item bigint, score double",
    )
    def top(**kw):
        return [(r["user"], r["item"], r["rank"]) for r in cf.cf_top_n(scores, **kw).orderBy("user", "rank").collect()]

    assert top(n=3) == [(1, 120, 1), (1, 9, 2), (1, 2, 3), (2, 1, 1)]
    assert top(n=2, users=[1], item_filter=scores["item"] < 100) == [(1, 9, 1), (1, 2, 2)]
    seen = spark.createDataFrame([(1, 120, 1), (1, 9, 0)], "user bigint, item bigint, r bigint")
    assert top(n=1, seen=seen) == [(1, 9, 1), (2, 1, 1)]


def test_top_in_the_task_changes_nothing(spark, matrix):
    seen = sparse(spark, matrix)
    for scores in (cf.cf_scores_item, cf.cf_scores_user):
        whole = cf.cf_top_n(scores(seen), 3).orderBy("user", "rank").collect()
        early = scores(seen, top=3)
        assert cf.cf_top_n(early, 3).orderBy("user", "rank").collect() == whole
        assert early.count() < scores(seen).count()


@pytest.mark.parametrize("max_dense", [2000, 0])
def test_sums_of_zero_or_less_are_similar_to_none(spark, monkeypatch, max_dense):
    monkeypatch.setattr(cf, "MAX_DENSE", max_dense)
    R = np.array([[1, -1, 0, 0], [1, 1, 1, 0], [0, -2, 1, 0], [2, 1, 0, 1], [0, 1, 1, 1]], float)
    Su, Si, Yu, Yi = brute(R)
    seen = sparse(spark, R).union(sparse(spark, R)).withColumn("r", cf.F.col("r") / 2)  # every cell twice
    assert dense(cf.item_similarity(seen), Si.shape, "i j sim".split()) == pytest.approx(Si)
    assert dense(cf.user_similarity(seen), Su.shape, "u v sim".split()) == pytest.approx(Su)
    assert dense(cf.cf_scores_item(seen), Yi.shape, "user item score".split()) == pytest.approx(Yi)
    assert dense(cf.cf_scores_user(seen), Yu.shape, "user item score".split()) == pytest.approx(Yu)


def pairs_of(R, at_least):
    Su = brute(R)[0]
    n = len(R)
    return {(u, v): round(float(Su[u, v]), 9) for u in range(n) for v in range(u + 1, n) if round(float(Su[u, v]), 9) >= at_least}


@pytest.mark.parametrize("at_least", [0.2, 0.5, 0.9])
@pytest.mark.parametrize("kind", ["ones", "counts", "signed"])
def test_similar_users(spark, matrix, at_least, kind):
    draw = np.random.default_rng(2)
    R = matrix * {"ones": 1, "counts": draw.integers(1, 5, matrix.shape), "signed": draw.choice([3, 2, -1], matrix.shape)}[kind]
    R[12] = R[11]
    found = cf.similar_users(sparse(spark, R), at_least, block_rows=5)
    got = {(r["u"], r["v"]): r["sim"] for r in found.collect()}
    assert got == pytest.approx(pairs_of(R, at_least))


def test_few_pairs_are_made(spark):
    draw = np.random.default_rng(4)
    R = np.zeros((300, 120))
    for u in range(300):  # popular items that nearly all share, and a few of a group's own
        R[u, :4] = draw.random(4) < 0.6
        R[u, 20 + u // 3] = 1
        R[u, draw.integers(4, 20, 3)] = 1
    rows_of = cf._unit_rows(cf._cells(sparse(spark, R)))
    expected = pairs_of(R, 0.8)
    made = {tuple(r) for r in cf.similar_candidates(rows_of, 0.8).collect()}
    assert set(expected) <= made
    sharing = int(np.count_nonzero(np.triu(R @ R.T, 1)))
    assert len(made) < sharing / 10
    prefixes, _ = cf._prefixes(rows_of, 0.8)
    sizes = [r["count"] for r in prefixes.groupBy("item").count().collect()]
    lists = R.sum(0)
    assert sum(n * (n - 1) / 2 for n in sizes) < sum(n * (n - 1) / 2 for n in lists) * 0.8


@pytest.mark.parametrize("start", [0.05, 0.5, 0.95])
def test_similar_users_top_n(spark, matrix, start):
    Su = np.round(brute(matrix)[0], 9)
    expected = []
    for u in range(len(matrix)):
        best = sorted((-Su[u, v], v) for v in range(len(matrix)) if v != u and Su[u, v] > 0)[:4]
        expected += [(u, v, -s, k + 1) for k, (s, v) in enumerate(best)]
    found = sorted(tuple(r) for r in cf.similar_users_top_n(sparse(spark, matrix), 4, start, block_rows=6).collect())
    assert [(r[0], r[1], r[3]) for r in found] == [(r[0], r[1], r[3]) for r in sorted(expected)]
    assert [r[2] for r in found] == pytest.approx([r[2] for r in sorted(expected)])


def test_no_limit_is_refused(spark, matrix):
    with pytest.raises(ValueError):
        cf.similar_users(sparse(spark, matrix), 0)
