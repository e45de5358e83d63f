import pytest
from conftest import rows

from lodeworks.operators import basket, cf, graph
from lodeworks.sources import readers, writers


def write(path, text):
    path.write_text(text)
    return str(path)


def lines_of(spark, path):
    return [r["value"] for r in spark.read.text(path).collect()]


def test_adjacency(spark, tmp_path):
    path = write(tmp_path / "adj.txt", "0\t1,2,10\n1\t0\n2\t0\n7\n10\t0\n\n")
    edges, vertices = readers.read_adjacency(spark, path)
    assert rows(vertices) == [(0,), (1,), (10,), (2,), (7,)]
    assert rows(edges) == sorted([(0, 1), (0, 2), (0, 10), (1, 0), (2, 0), (10, 0)], key=repr)


def test_baskets_keep_repeats_and_colons(spark, tmp_path):
    path = write(tmp_path / "b.txt", "x y x \n\na:b c\n")
    found = readers.read_baskets(spark, path)
    grouped = sorted(sorted(r["items"]) for r in found.groupBy("basket_id").agg({"item": "collect_list"}).toDF("b", "items").collect())
    assert grouped == [["a:b", "c"], ["x", "x", "y"]]


@pytest.mark.parametrize("split", [None, "400b"])
def test_line_numbers(spark, tmp_path, split):
    text = "".join(f"{n} {n * 2} {n % 5 + 1}\n" for n in range(500))
    path = write(tmp_path / "r.txt", text)
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = readers.read_ratings(spark, path)
        assert sorted(tuple(r) for r in found.collect()) == [(n, n, n * 2, float(n % 5 + 1)) for n in range(500)]
        if split:
            assert spark.read.text(path).rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_vectors_points_centroids(spark, tmp_path):
    csv = readers.read_csv_vectors(spark, write(tmp_path / "p.csv", "1,2.5\n3, 4\n"))
    assert rows(csv) == [(0, [1.0, 2.5]), (1, [3.0, 4.0])]
    points = readers.read_points(spark, write(tmp_path / "d.txt", "0 .5  1e2\n1 2 3\n"))
    assert sorted(r["v"] for r in points.collect()) == [[0.0, 0.5, 100.0], [1.0, 2.0, 3.0]]
    centroids = readers.read_centroids(spark, write(tmp_path / "c.txt", "0 1\n2 3\n"))
    assert rows(centroids) == [(0, [0.0, 1.0]), (1, [2.0, 3.0])]


def test_seen_and_titles(spark, tmp_path):
    seen = readers.read_seen(spark, write(tmp_path / "r.txt", "0 1 1\n0 0 0\n1 0 0\n"))
    assert rows(seen) == [(0, 1, 1), (0, 2, 1), (2, 0, 1)]
    titles = readers.read_titles(spark, write(tmp_path / "s.txt", '"The Show"\n  "A ""b"""  \n""\n'))
    assert rows(titles) == [(0, "The Show"), (1, 'A ""b""'), (2, "")]


def test_friend_report(spark, tmp_path):
    edges, vertices = readers.read_adjacency(spark, write(tmp_path / "a.txt", "1\t9,10\n9\t1\n10\t1\n7\n"))
    out = str(tmp_path / "out")
    writers.write_friends(graph.recommend_friends(edges, vertices), out)
    assert lines_of(spark, out) == ["1", "7", "9 \t 10", "10 \t 9"]


def test_rule_reports(spark, tmp_path):
    held = readers.read_baskets(spark, write(tmp_path / "b.txt", "a b c\n" * 3 + "a b\nc\n"))
    items, pairs = basket.frequent_items(held, 2), basket.frequent_pairs(held, 2)
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    writers.write_rules(basket.rules_1to1(items, pairs), one)
    found = lines_of(spark, one)
    assert found[:2] == ["Conf: 1.00000000\tRule: a => b", "Conf: 1.00000000\tRule: b => a"]
    assert "Conf: 0.75000000\tRule: a => c" in found and len(found) == 6
    writers.write_rules(basket.rules_2to1(pairs, basket.frequent_triples(held, 2)), two)
    assert lines_of(spark, two)[0] == "Conf: 1.00000000\tRule: (a, c) => b"


def test_score_and_trace_reports(spark, tmp_path):
    seen = readers.read_seen(spark, write(tmp_path / "r.txt", "1 1 0\n1 0 1\n"))
    titles = readers.read_titles(spark, write(tmp_path / "s.txt", '"A"\n"B"\n"C"\n'))
    out = str(tmp_path / "scores")
    writers.write_scores(cf.cf_top_n(cf.cf_scores_item(seen), 1, users=[0]), titles, out)
    assert lines_of(spark, out) == ["\tSimilarity score = 1.70711 \tMovie:  A"]
    trace = spark.createDataFrame([("l2", "x", 2, 5.0), ("l2", "x", 1, 10.0)], "metric string, init string, iteration int, cost double")
    path = str(tmp_path / "trace")
    writers.write_trace(trace, path)
    assert [tuple(r) for r in spark.read.csv(path, header=True, inferSchema=True).collect()] == [
        ("l2", "x", 1, 10.0), ("l2", "x", 2, 5.0)
    ]
    drops = spark.createDataFrame([("l2", "x", 50.0, 50.0)], "metric string, init string, pct_of_first double, pct_dropped double")
    assert writers.cost_lines(drops).first()["value"] == "l2 x: Cost changed to: 50.00%\tDropped: 50.00%"
    writers.write_parquet(trace, str(tmp_path / "pq"))
    assert rows(readers.read_parquet(spark, str(tmp_path / "pq"))) == rows(trace)


@pytest.mark.parametrize("bad", ["1 2", "1 2 3 4", ""])
def test_malformed_ratings_stop(spark, tmp_path, bad):
    found = readers.read_ratings(spark, write(tmp_path / "bad.txt", f"1 2 3\n{bad}\n4 5 1\n"))
    with pytest.raises(Exception, match="line 1 is not"):
        found.count()
