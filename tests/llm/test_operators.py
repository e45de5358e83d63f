"""The operators of lodeworks.llm on small tables, against brute force and exact round trips."""

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodeworks.llm import (
    decontaminate,
    grading,
    host_rules,
    html_text,
    mixing,
    near_dedup,
    stages,
    suffix_dedup,
    token_shards,
    url_filter,
    warc,
)
from lodeworks.llm.byte_words import words_of
from lodeworks.llm.common import keep, numbered
from lodeworks.llm.components import components
from lodeworks.llm.permute import feistel

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, source string, lang string"


def prose(seed, n):
    draw = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in draw.integers(0, 4000, n))


def odd_docs(spark):
    """NULLs, empty and long texts, repeated rows."""
    long = prose(1, 30_000)
    rows = [
        (1, prose(2, 120), "a", "en"), (2, prose(2, 120), "a", "en"), (2, prose(2, 120), "a", "en"),
        (3, None, "a", None), (4, "", None, "en"), (None, prose(3, 90), None, "en"), (5, long, "b", "en"),
        (6, "... !!", "b", "en"), (7, "one two", "b", "en"), (8, prose(2, 119) + " end", "c", "en"),
    ]
    return spark.createDataFrame(rows, DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def test_words_are_those_of_the_pattern():
    texts = ["Ab-c 9é\x00x", "", None, "ßA b", "zzz"]
    words = words_of(pa.array(texts))
    lower = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "") for t in texts]
    expected = [WORDS.findall(t) for t in lower]
    assert np.diff(words.first).tolist() == [len(x) for x in expected]
    flat = [w for x in expected for w in x]
    named = collections.defaultdict(set)
    for w, h in zip(flat, words.hashes.tolist()):
        named[w].add(h)
    assert all(len(h) == 1 for h in named.values()) and len({h for s in named.values() for h in s}) == len(named)


@pytest.mark.parametrize("n", [1, 2, 5, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    out = feistel(np.arange(n), n, 7)
    assert sorted(out.tolist()) == list(range(n))
    assert n < 64 or out.tolist() != feistel(np.arange(n), n, 8).tolist()


def test_shards_hold_every_token_once(spark, tmp_path):
    docs = odd_docs(spark).repartition(3)
    vocabulary = token_shards.public_vocabulary()
    shards, spans = token_shards.write_shards(docs, vocabulary, f"{tmp_path}/shards", sequence_tokens=64, shard_slots=50)
    length, got = shards.sequence_tokens, {}
    for row in token_shards.read_slots(spark, shards).collect():
        got[row["slot"]] = np.frombuffer(row["tokens"], shards.dtype)
    assert sorted(got) == list(range(shards.sequences))
    place = feistel(np.arange(shards.sequences), shards.sequences, shards.key)
    stream = np.concatenate([got[s] for s in place.tolist()])
    texts = collections.Counter()
    for row in spans.collect():
        own = stream[row["at"] : row["at"] + row["n"]]
        assert own[-1] == vocabulary.end
        texts[row["doc_id"], vocabulary.encoder().decode(own[:-1].tolist())] += 1
    assert texts == collections.Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert (stream[shards.tokens :] == vocabulary.end).all()
    later = {r["slot"] for r in token_shards.read_slots(spark, shards, 120).collect()}
    assert later == set(range(120, shards.sequences))
    rows = token_shards.manifest(spark, shards, spans).collect()
    assert sorted(r["slot"] for r in rows) == sorted(got)
    for r in rows:
        assert r["tokens_sha256"] == hashlib.sha256(got[r["slot"]].tobytes()).hexdigest()
        assert place[r["sequence"]] == r["slot"] and r["byte_offset"] == (r["slot"] % 50) * 2 * length


def test_no_documents_make_no_shards(spark, tmp_path):
    shards, spans = token_shards.write_shards(no_docs(spark), token_shards.public_vocabulary(), f"{tmp_path}/none")
    assert token_shards.manifest(spark, shards, spans).count() == 0


def test_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = spark.range(0, 20_000, 37).select(F.concat(F.lit("k"), "id").alias("key"))
    found = url_filter.cascade(listed, universe)
    h1, h2 = url_filter._hashes(F.col("key"))
    rows = universe.select("key", h1.alias("h1"), h2.alias("h2")).toPandas()
    got = found.contains(rows["h1"].to_numpy().view(np.uint64), rows["h2"].to_numpy().view(np.uint64))
    assert got.tolist() == [int(k[1:]) % 37 == 0 for k in rows["key"]] and len(found.levels) > 1


def test_url_rules(spark):
    urls = [
        ("http://a.example.org/en/12?x", "a.example.org", "/en/12", "example.org/en/1", "block"),
        ("http://Example.ORG/es/", "example.org", "/es/", "example.org/es/", "block"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("https://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
        ("https://x.org#t", "x.org", "", None, "allow"),
        ("https://spam-farm.net/fr/", "spam-farm.net", "/fr/", None, "block"),
        ("no host", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
        ("https://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
    ]
    pages = spark.createDataFrame([(i, u[0], "clash") for i, u in enumerate(urls)], "page_id int, url string, rule string")
    got = url_filter.judge_urls(pages).orderBy("page_id").select("host", "path", "rule", "verdict").collect()
    assert [tuple(r) for r in got] == [u[1:] for u in urls]
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def hit_words(text, items):
    words = WORDS.findall((text or "").lower())
    hit, names = set(), set()
    for name, item in items:
        own = WORDS.findall((item or "").lower())
        n = min(10, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                names.add(str(name) if name is not None else "")
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("most", [2_000_000, 40])
def test_decontamination_against_brute_force(spark, most):
    items = [(1, prose(9, 30)), (2, prose(9, 25)), (10, "alpha beta gamma"), (None, "solo"), (3, None), (4, ""), (1, prose(9, 30))]
    texts = [prose(9, 30), "x " * 9 + prose(9, 12), prose(9, 9), "Alpha, BETA gamma solo", None, "", prose(5, 400), "alpha beta alpha beta gamma"]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id int, text string, spans int")
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    found = decontaminate.matched(docs, benchmark, max_windows=most)
    for row in decontaminate.digest(found).collect():
        n, hit, names = hit_words(texts[row["doc_id"]], items)
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (n, hit, len(names))
        assert row["items_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert row["contaminated"] == (hit > 0)
    assert decontaminate.digest(decontaminate.matched(docs, benchmark.limit(0))).where("contaminated").count() == 0
    assert decontaminate.matched(docs.limit(0), benchmark).count() == 0


def test_grades_of_held_out_rows(spark):
    rows, labels = [], []
    for i in range(900):
        kind = i % 3
        rows.append((i, prose(i, 80).upper() + " !!" * 40 if kind == 0 else prose(i, 80) + (" vile nasty" if kind == 1 else "")))
        labels.append((i, int(kind > 0), int(kind == 1)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    graded = grading.graded(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    model = grading.fit(grading.examples(docs, graded))
    assert (np.diff(model.thresholds) > 0).all()
    held = grading.scored(docs, model).join(graded.where(grading._fold() == 0), "doc_id").collect()
    assert len(held) > 50 and np.mean([r["kept"] == (r["grade"] == 2) for r in held]) > 0.95
    assert grading.scored(odd_docs(spark), model).count() == 10
    none = grading.fit(grading.examples(docs, graded.limit(0)))
    assert not none.weights.any()


def test_sample_holds_to_its_bound(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(400)] + [(7, 1, 1)] * 5000, "doc_id bigint, quality int, toxic int")
    docs = spark.createDataFrame([(i, prose(i, 20)) for i in range(400)] + [(7, "other words")] * 3000, "doc_id bigint, text string")
    grades = grading.graded(labels)
    for bound in (50, 10_000):
        got = grading.examples(docs, grades, bound).collect()
        assert len(got) == min(bound, grades.where(grading._fold() != 0).count())
        assert len({(r["doc_id"], r["grade"]) for r in got}) == len(got)
        again = grading.examples(docs.repartition(3), grades.repartition(5), bound).collect()
        assert sorted(map(str, got)) == sorted(map(str, again))


def test_grade_probabilities_and_one_step_against_plain_formulas(monkeypatch):
    draw = np.random.default_rng(5)
    lists = [np.unique(draw.integers(0, 12, 4)) for _ in range(60)]
    grades, weights = draw.integers(0, grading.GRADES, 60), draw.normal(0, 0.5, 16)
    raw = np.array([-0.4, 0.7])

    def chances(w, t, features):
        below = [1 / (1 + np.exp(-(x - sum(w[f] for f in features)))) for x in t]
        return np.diff([0, *below, 1])

    def loss(w, t):
        fit = -sum(np.log(chances(w, t, f)[g]) for f, g in zip(lists, grades))
        return fit + grading.SHRINK / 2 * sum(w[f] ** 2 for f in range(12))

    model = grading.Model(weights.astype(np.float32), raw)
    grade, top = model.judge(np.array([weights[f].sum() for f in lists]))
    plain = np.array([chances(weights, raw, f) for f in lists])
    assert np.allclose(grade, plain @ np.arange(grading.GRADES)) and np.allclose(top, plain[:, -1])

    for name, value in {"MIN_ROWS": 0, "MIN_DEVIATIONS": 0, "EPOCHS": 1, "BATCH": 1000}.items():
        monkeypatch.setattr(grading, name, value)
    learnt = grading._learn(model, grades, lists, 0)

    def slope(of, x):
        return np.array([(of(x + e) - of(x - e)) / 2e-5 for e in np.eye(len(x)) * 1e-5])

    by_weight, by_threshold = slope(lambda w: loss(w, raw), weights), slope(lambda t: loss(weights, t), raw)
    by_weight[12:] = 0
    assert np.allclose(learnt.weights, weights - grading.RATE * by_weight / np.sqrt(1e-2 + by_weight**2), atol=1e-4)
    assert np.allclose(learnt.thresholds, raw - grading.RATE * by_threshold / np.sqrt(1e-2 + by_threshold**2), atol=1e-4)


def bag(text):
    words = WORDS.findall((text or "").lower())
    n = min(5, len(words))
    return collections.Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else collections.Counter()


def alike(a, b):
    shared = sum((a & b).values())
    return shared / max(1, sum(a.values()) + sum(b.values()) - shared)


def test_signatures_estimate_weighted_similarity():
    pairs = []
    for s in range(40):
        base = prose(s, 60).split()
        other = base[: 40 + s % 20] + prose(s + 500, 10).split() + ["again", "and"] * (s % 7)
        pairs += [" ".join(base + ["again", "and"] * 5), " ".join(other)]
    words = words_of(pa.array(pairs))
    times = near_dedup.signatures(*near_dedup.shingles(words, len(pairs)), len(pairs))
    assert np.isfinite(times).all()
    true = np.array([alike(bag(pairs[i]), bag(pairs[i + 1])) for i in range(0, len(pairs), 2)])
    seen = (times[::2] == times[1::2]).mean(axis=1)
    assert abs((seen - true).mean()) < 0.02 and np.abs(seen - true).max() < 0.25


def test_near_duplicates_against_brute_force(spark):
    texts, draw = [], np.random.default_rng(4)
    for s in range(25):
        base = prose(s + 50, 100).split()
        for k in range(6):
            copy = list(base)
            for at in draw.integers(0, 100, k):
                copy[at] = f"x{s}y{k}"
            texts.append(" ".join(copy))
    texts += [texts[0], "", None, "a b", "a b", "?!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["_class"] for r in near_dedup.grouped(docs).collect()}
    bags = [bag(t) for t in texts]
    above = list(range(len(texts)))
    for _ in texts:
        before = list(above)
        for i in range(len(texts)):
            for j in range(i):
                if bags[i] and bags[j] and alike(bags[i], bags[j]) >= 0.8:
                    above[i] = above[j] = min(above[i], above[j])
        if above == before:
            break
    classes = collections.defaultdict(set)
    for i, b in enumerate(bags):
        if b:
            classes[above[i]].add(got[i])
        else:
            assert got[i] is None
    assert all(len(c) == 1 for c in classes.values()) and len({x for c in classes.values() for x in c}) == len(classes)
    assert near_dedup.deduplicated(docs).count() == len(classes) + sum(not b for b in bags)
    assert near_dedup.grouped(no_docs(spark)).count() == 0


def group_of_copies(n, words=120):
    """Copies of one text with up to two of five words changed: a mixed group, some of it alike, some not."""
    draw, base = np.random.default_rng(n), prose(77, words).split()
    texts = []
    for k in range(n):
        copy = list(base)
        for at in draw.integers(0, words, draw.integers(0, words // 14)):
            copy[at] = f"y{k}z{at}"
        texts.append(" ".join(copy))
    return texts


def plain_classes(texts):
    """Components by a plain loop over all pairs."""
    bags, above = [bag(t) for t in texts], list(range(len(texts)))

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if top(i) != top(j) and alike(bags[i], bags[j]) >= 0.8:
                above[top(i)] = top(j)
    return [top(i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [16, 512])
def test_a_hot_bucket_in_blocks_loses_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = group_of_copies(220)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id bigint, text string, _class string, _row string")
    got = [r["_class"] for r in near_dedup.grouped(docs).orderBy("doc_id").collect()]
    expected = plain_classes(texts)
    assert len(set(expected)) > 5 and len(set(zip(got, expected))) == len(set(got)) == len(set(expected))
    kept = near_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(expected)) and kept.where("_class <> 'x' or _row <> 'y'").count() == 0


def test_near_duplicates_of_files_are_not_copied(spark, tmp_path):
    texts = [*group_of_copies(30), "", None, "a b", "a b"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, _metadata string")
    docs.drop("_metadata").repartition(3).write.parquet(f"{tmp_path}/docs")
    docs.write.parquet(f"{tmp_path}/named")
    read = spark.read.parquet(f"{tmp_path}/docs")
    # Of a joined table rows may share a place in a file.
    twice = read.join(spark.createDataFrame([(i % 34, f"{i // 34}") for i in range(68)], "doc_id bigint, time string"), "doc_id")
    classes = plain_classes(texts)
    least = {c: min(i for i, x in enumerate(classes) if x == c) for c in classes}
    expected = sorted([i for i, t in enumerate(texts) if not t or least[classes[i]] == i])
    for given in (docs, read, spark.read.parquet(f"{tmp_path}/named"), twice):
        kept = near_dedup.deduplicated(given)
        times = 2 if given is twice else 1
        assert kept.columns == given.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted([i for i in expected for _ in range(1 if texts[i] else times)])
        if given is read:
            assert not any("sketches" in f or "near-docs" in f for f in kept.inputFiles())


def test_a_hot_bucket_makes_few_links(spark):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(group_of_copies(2000, 60))], "_row bigint, _text string")
    rows = near_dedup._bags(texts).selectExpr("1 as _bucket", "node % 4 as _lo", "node % 4 as _hi", "node", "bag", "node as label")
    assert near_dedup._linked(rows, 0.8).count() < 2000


def test_overlap_of_bags_is_exact():
    texts = [*group_of_copies(40, 30), "a b c d e " * 30, "a b c d e " * 20, "a b", "a b", "b a"]
    owner, found = near_dedup.elements(words_of(pa.array(texts)), len(texts))
    near = near_dedup.alike([np.sort(found[owner == i]) for i in range(len(texts))], 0.8)
    np.fill_diagonal(near, True)
    assert near.tolist() == [[alike(bag(a), bag(b)) >= 0.8 for b in texts] for a in texts]
    links = near_dedup.forest(near & ~np.eye(len(texts), dtype=bool))
    assert len(links) == len(texts) - len(set(plain_classes(texts)))


def test_components_of_a_path_and_a_star(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("500", f"{i}") for i in range(600, 640)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {got[f"{i:03}"] for i in range(41)} == {"000"} and {got[str(i)] for i in range(600, 640)} == {"500"}


def test_mix_near_targets_and_the_same_again(spark):
    rows = [(i, prose(i, 30 + i % 50), None if i % 11 == 0 else f"s{i % 4}", "en") for i in range(600)] + [(700, None, "s1", "en"), (701, "", "zero", "en")]
    docs = spark.createDataFrame(rows, DOCS)

    def run(parts):
        mixed = mixing.mix(keep(mixing.sized(docs.repartition(parts)), "t"), block_words=8)
        return mixed, {r["doc_id"]: r for r in mixing.taken(mixed).collect()}

    mixed, got = run(3)
    assert len(got) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in got.values())
    assert {k: r["taken"] for k, r in got.items()} == {k: r["taken"] for k, r in run(5)[1].items()}
    by = collections.defaultdict(lambda: [0, 0.0])
    for r in got.values():
        by[r["source"]][0] += r["taken"]
        by[r["source"]][1] = r["target"]
    assert all(abs(a - b) <= 0.03 * b + 8 for a, b in by.values())
    assert abs(sum(b for _, b in by.values()) - 1.5 * sum(r["size"] for r in got.values())) < 1e-6
    words = collections.Counter()
    for r in mixing.drawn(mixed).collect():
        words[r["doc_id"]] += len(r["text"].split())
    assert all(words[k] == r["taken"] for k, r in got.items())
    empty = mixing.mix(keep(mixing.sized(no_docs(spark)), "t"))
    assert mixing.taken(empty).count() == 0


def test_host_rules(spark):
    bad = [(100 + i, "too short", "bad", "en") for i in range(60)] + [(200, prose(8, 80), "bad", "en")]
    good = [(300 + i, prose(i, 80), "good", "en") for i in range(60)]
    rows = spark.createDataFrame(bad + good, DOCS).union(odd_docs(spark))
    got = host_rules.judge(keep(host_rules.measured(rows), "t")).collect()
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert len(got) == 131 and 200 not in kept and {300 + i for i in range(60)} <= kept and not {3, 4, 6, 7} & kept
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        count = collections.Counter(zip(words, words[1:], words[2:]))
        held = {i + k for i in range(len(words) - 2) if count[tuple(words[i : i + 3])] > 1 for k in range(3)}
        assert (r["n_words"], r["n_repeat_words"]) == (len(words), len(held))
    assert host_rules.judge(keep(host_rules.measured(no_docs(spark)), "t")).count() == 0


def test_main_text(spark):
    page = (
        "<html><head><title>t</title></head><body><header>top</header><nav><a href=x>menu</a></nav>"
        "<div class='cookie-notice'>we use</div><article><h1>A &amp; B</h1><p>one\n two<br>three<p>four"
        "<script>var a='<p>';</script><form>mail</form><div class=ad>buy</div><ul><li>x<li>y</ul>"
        "<section class='comments'><p>first!</p></section></article><aside>more</aside><footer>end</footer></body></html>"
    )
    rows = [(1, "http://a.b/1", page), (2, "http://a.b/2", None), (3, None, ""), (4, "http://a.b/3", "<nav>only</nav>"), (5, "u", "plain &lt;b&gt; text"), (6, "http://a.b/9", "<div><p>" + "long " * 9000)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()}
    assert got[1] == "A & B\none two three\nfour\nx\ny"
    assert got[2] == got[3] == got[4] == "" and got[5] == "plain <b> text" and got[6] == ("long " * 9000).strip()
    assert html_text.main_text(pages.limit(0)).count() == 0


def body_text(i, n=4):
    return [f"Paragraph {j} of page {i} says a thing about it, and then some more words." for j in range(n)]


# What surrounds an article on a page, with `{}` for its blocks. Boilerplate says BAD.
TEMPLATES = [
    '<div style="overflow:hidden"><article>{}</article></div>',
    '<div class="has-sidebar layout"><article>{}</article><div class="sidebar">BAD</div></div>',
    '<div class="with-menu"><div class="menu">BAD</div><div class="content">{}</div></div>',
    '<article><header class="entry-header"><h1>Title</h1></header>{}</article>',
    '<div class="post"><div class="post-header"><h1>Title</h1></div>{}</div>',
    "<nav>BAD</nav><main>{}</main><footer>BAD</footer>",
    '<main><article>{}</article><section class="comments"><article class="comment"><p>BAD</p></article></section></main>',
    '<div id="content">{}</div><div id="comments"><p>BAD BAD</p><p>BAD</p></div>',
    '<article><h2>teaser</h2></article><div class="text">{}</div>',
    '<table><tr><td class="nav">BAD</td><td>{}</td></tr></table>',
    '<div role="banner">BAD</div><section>{}</section>',
    '<div class="cookie-notice"><p>BAD</p><p>BAD</p></div><article>{}</article>',
    '<article>{}<p class="ad">BAD</p><aside>BAD</aside></article>',
    '<article>{}<form>BAD</form><div class="share">BAD</div><script>BAD</script></article>',
    '<div class="article-body" data-role="menu" title="a hidden gem">{}</div>',
]
MARKED = [
    '<p data-id="menu-1">{}</p>', '<p title="a hidden gem">{}</p>', '<p id="comments-policy">{}</p>', '<p class="related">{}</p>',
]


@pytest.mark.parametrize("template", TEMPLATES)
def test_templates_give_their_articles(template):
    said = body_text(1)
    marked = "".join(m.format(t) for m, t in zip(MARKED, said))
    got = html_text.extract(f"<html><head><title>BAD</title></head><body>{template.replace('{}', marked)}</body></html>", [])
    want = (["Title"] if "Title" in template else []) + said
    # A teaser that stands before the body may come with it.
    assert [t for t in got.split("\n") if t != "teaser"] == want


def test_every_template_of_a_host_keeps_its_pages(spark):
    rows, want = [], {}
    for i in range(45):
        said = body_text(i)
        page = TEMPLATES[i % 15].replace("{}", "".join(f"<p>{t}</p>" for t in said)).replace('class="', f'class="t{"abc"[i % 3]} ')
        rows.append((i, "http://one.example/x" if i % 2 else None, f"<body>{page}</body>", "clash"))
        want[i] = said
    pages = spark.createDataFrame(rows + rows[:3], "page_id int, url string, html string, _path string")
    found = html_text.main_text(pages).collect()
    assert len(found) == 48
    for r in found:
        lines = [t for t in r["text"].split("\n") if t not in ("Title", "teaser")]
        assert lines == want[r["page_id"]] and r["n_chars"] == len(r["text"])


def test_votes_against_a_plain_count(spark):
    pages = [("http://h/1", f"<body><div class='c{i % 3} {'xyz'[i % 3]}'><p>{t}</p></div></body>") for i, t in enumerate(body_text(0, 12))]
    counted = html_text.votes(spark.createDataFrame(pages, "url string, html string"))
    plain = collections.Counter(html_text.best(html_text.blocks(h)).path for _, h in pages)
    assert {r["path"]: r["n"] for r in counted.collect()} == dict(plain) and len(plain) == 3
    ranked = html_text.winners(counted).first()["_paths"]
    assert sorted(ranked) == sorted(plain)
    assert html_text.winners(counted, votes=1).count() == 0


def test_archives_round_trip(spark, tmp_path):
    odd = "a\r\n\r\nb\r\n\r\n\r\nWARC/1.1\r\n"
    rows = [(5, "http://h/5", odd), (2, "http://h/2", odd), (9, None, None), (7, "http://h/7", ""), (None, "http://h/n", odd), (3, "http://h/é", "é" * 3000), (3, "http://h/é", "é" * 3000), (4, "x\r\ny", "\r\n")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    warc.write(pages.coalesce(2), f"{tmp_path}/w")
    captures = warc.assemble(warc.read(spark, f"{tmp_path}/w", with_payload=True))
    held = collections.Counter(bytes(r["response"]["payload"]) for r in captures.collect() if r["response"]["type"] == "response")
    assert held == collections.Counter([odd.encode(), b"", ("é" * 3000).encode(), ("é" * 3000).encode(), b"\r\n"])
    got = collections.Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.digests(captures).collect())
    n = len(odd)
    assert got == collections.Counter([(5, n, "revisit", 2), (2, n, "response", None), (None, n, "revisit", 2), (9, 0, "revisit", 7), (7, 0, "response", None), (3, 6000, "response", None), (3, 6000, "response", None), (4, 2, "response", None)])
    warc.write(pages.limit(0), f"{tmp_path}/none")
    assert warc.assemble(warc.read(spark, f"{tmp_path}/none")).count() == 0


def test_repeated_strings_against_brute_force(spark):
    draw = np.random.default_rng(3)
    shared = prose(70, 150)
    texts = [prose(i, 100) for i in range(6)] + [prose(20, 40) + shared + prose(21, 40), shared + prose(22, 90), prose(23, 9) + shared[: len(shared) - 7], "ab" * 700, "x" * 399, None, "", "é" * 500]
    texts += [texts[0], prose(24, 30) + texts[1][int(draw.integers(5, 30)) :]]
    # Passages cut anywhere, so that pieces of all lengths meet.
    passage = prose(71, 220)
    for i in range(60):
        start, size = int(draw.integers(0, 500)), int(draw.integers(380, 700))
        texts.append(prose(100 + i, int(draw.integers(0, 30))) + passage[start : start + size] + prose(200 + i, int(draw.integers(0, 30))))
    length, seen = suffix_dedup.LENGTH, collections.Counter()
    raw = [(t or "").encode() for t in texts]
    for b in raw:
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, n_spans int")
    for row in suffix_dedup.cut(docs).collect():
        b = raw[row["doc_id"]]
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        assert bytes(row["kept"]) == np.frombuffer(b, np.uint8)[~gone].tobytes()
        assert row["n_removed"] == gone.sum() and row["n_spans"] == sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
    assert suffix_dedup.cut(docs.limit(0)).count() == 0


def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline

    rows = [(i, prose(i // 2, 90), f"s{i % 3}", "en", i) for i in range(40)] + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS + ", size int")
    names = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = keep(stage(spark, docs, "/root/testdata/sf0.001"), "t")
        assert docs.columns == names and docs.count() > 0
    ids = {r["doc_id"] for r in docs.collect()}
    assert ids <= set(range(0, 40, 2)) and len(ids) >= 15
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0


def test_rows_are_numbered_by_place(spark, tmp_path):
    docs = odd_docs(spark).repartition(3)
    docs.write.parquet(f"{tmp_path}/docs")
    read = spark.read.parquet(f"{tmp_path}/docs")
    once, again = (numbered(read.select("text", "doc_id"), "copy").select("_row", "text", "doc_id") for _ in range(2))
    assert sorted(map(repr, once.collect())) == sorted(map(repr, again.repartition(2).collect()))
    assert once.select("_row").distinct().count() == docs.count()
    made = numbered(docs, "copy")
    assert made.select("_row").distinct().count() == docs.count() and made.columns == [*docs.columns, "_row"]


def test_mixing_stage_of_files_and_of_other_rows(spark, tmp_path):
    rows = [(i, prose(i, 200 + i), f"s{i % 3}", "en") for i in range(30)] + [(3, prose(3, 203), "s0", "en")]
    docs = spark.createDataFrame(rows, DOCS)
    docs.repartition(4).write.parquet(f"{tmp_path}/docs")
    read = spark.read.parquet(f"{tmp_path}/docs")
    twice = read.join(spark.createDataFrame([(i % 30,) for i in range(60)], "doc_id bigint"), "doc_id")
    for given in (docs, read, twice.select(docs.columns)):
        words = given.select(F.sum(mixing.size_of("text"))).first()[0]
        out = stages.mixing(spark, given, None)
        total = out.select(F.sum(mixing.size_of("text"))).first()[0]
        assert out.columns == docs.columns and abs(total - 1.5 * words) < 0.1 * words
