"""BPE codec, lexical ranking and spelling variants against brute force, the last two also on odd tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodeworks.llm import bpe_codec, lexical_rank, spelling
from lodeworks.llm.byte_words import texts_of

DOCS = "doc_id bigint, text string, ids string, n_tokens string, term string, word string, _item int, rank int"
PIECES = ["a", "b", "s", "t", "re", "'", " ", "  ", "\n", "\t", "　", "\xa0", "é", "ß", "中", "1", "٣", "!", "…", "'s", "'ll", "L", "́", "😀", "\x1c", "\x85", "ⅷ", "don't"]


def frame(spark, rows, clash="x"):
    return spark.createDataFrame([(*r, *[clash] * 4, 1, 2) for r in rows], DOCS)


def odd_rows():
    """NULLs, empty and long texts, repeated rows and ties."""
    draw = random.Random(4)
    names = [f"{a}{b}wort{c}" for a, b, c in itertools.product("aeio", "kl", "mnst")]
    texts = [" ".join(draw.choices(names, k=draw.randint(1, 40))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, (7, texts[7]), (7, texts[7]), (100, None), (101, ""), (None, texts[3]), (102, "... !"), (103, " ".join(texts) * 40), (104, "x" * 70_000)]


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    return bpe_codec.Model.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(model):
    import tiktoken

    tokens, ranks = bpe_codec.parsed(model.lines)
    return tiktoken.Encoding("own", pat_str=model.pattern, mergeable_ranks=dict(zip(tokens, ranks)), special_tokens={})


def test_the_hash_is_minimal_perfect_and_exact(model):
    tokens, _ = bpe_codec.parsed(model.lines)
    assert sorted(model.tier.key_of_slot.tolist()) == list(range(len(tokens)))
    asked = [*tokens, *[t + b"\x00" for t in tokens], b"", *[t[:-1] + b"\xff" for t in tokens]]
    sizes = np.array([len(a) for a in asked])
    raw = np.frombuffer(b"".join(asked) + bytes(8), np.uint8)
    own = {t: i for i, t in enumerate(tokens)}
    assert model.tier.find(raw, np.cumsum(sizes) - sizes, sizes).tolist() == [own.get(a, -1) for a in asked]
    assert bpe_codec.PerfectHash([]).find(raw, np.array([0]), np.array([3])).tolist() == [-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), st.lists(st.sampled_from(PIECES), max_size=14).map("".join)), max_size=8))
def test_ids_are_those_of_the_library(model, library, texts):
    ids, first = model.codec().encode(*texts_of(pa.array(texts, pa.string())))
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [library.encode_ordinary(t or "") for t in texts]
    assert model.codec().decode(ids)[0].tobytes() == "".join(t or "" for t in texts).encode()


def test_every_sign_and_long_pieces(model, library):
    signs = "".join(chr(x) for x in range(0x20000) if not 0xD800 <= x < 0xE000)
    texts = [signs, signs[::-1], " ".join(signs[:5000]), "x" * 30_000, "ab" * 20_000, " " * 5000, "é" * 9000]
    ids, first = model.codec().encode(*texts_of(pa.array(texts)))
    for text, a, b in zip(texts, first, first[1:]):
        assert ids[a:b].tolist() == library.encode_ordinary(text)


def test_another_pattern_takes_the_same_tiers(model):
    import tiktoken

    pattern = r"\w+|[^\w]"
    tokens, ranks = bpe_codec.parsed(model.lines)
    other = bpe_codec.Codec(tokens, ranks, pattern, model.tier)
    library = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=dict(zip(tokens, ranks)), special_tokens={})
    texts = ["Some words, über-lange Wörter\n\nand 12 more…", "", "x"]
    ids, first = other.encode(*texts_of(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [library.encode_ordinary(t) for t in texts]


def test_encoding_tables(spark, model, library):
    rows = odd_rows()
    out = bpe_codec.decoded(bpe_codec.encoded(frame(spark, rows).repartition(3), model).withColumn("kept", F.col("ids")), model)
    assert out.columns == ["doc_id", "term", "word", "_item", "rank", "n_tokens", "kept", "decoded"]
    got = sorted((r["doc_id"] is None, r["doc_id"], np.frombuffer(r["kept"], "<u4").tolist(), r["n_tokens"], bytes(r["decoded"])) for r in out.collect() if r["doc_id"] is not None)
    expected = sorted((False, i, ids := library.encode_ordinary(t or ""), len(ids), (t or "").encode()) for i, t in rows if i is not None)
    assert got == expected
    assert out.where("doc_id is null").count() == 1
    assert bpe_codec.decoded(bpe_codec.encoded(frame(spark, []), model), model).count() == 0
    with pytest.raises(ValueError):
        model.codec().decode(np.array([60_000]))


TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plainly_ranked(docs, items, top=10):
    bags = [(i, collections.Counter(terms_of(t))) for i, t in docs]
    N, L = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    out = []
    for item, text in items:
        scored = []
        for doc, bag in bags:
            n, score = sum(bag.values()), 0
            for term in terms_of(text):
                if tf := bag[term]:
                    df = sum(term in b for _, b in bags)
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * (25 + 75 * n * N // L)))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_entries", [50_000, 20])
def test_ranks_against_brute_force(spark, block_entries):
    docs = odd_rows()
    texts = [t for _, t in docs[:12]]
    items = [(i, t[:60].upper()) for i, t in enumerate(texts)]
    items += [(3, items[3][1]), (None, texts[0] + texts[1]), (50, None), (51, ""), (52, "nowhere"), (53, f"{texts[2]} {texts[2]}")]
    found = lexical_rank.ranked(frame(spark, docs).repartition(4), frame(spark, items).withColumnRenamed("doc_id", "item_id"), block_entries=block_entries)
    assert sorted(map(tuple, found.collect()), key=repr) == plainly_ranked(docs, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]


def test_ranks_of_empty_tables(spark):
    docs, none = frame(spark, odd_rows()), frame(spark, [])
    assert lexical_rank.ranked(none, docs.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert lexical_rank.ranked(docs, none.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_shared_sets_are_nodes_once():
    common = [f"c{i}".encode() for i in range(40)]
    entries = [(item, t, 1) for item in range(30) for t in common[: 10 + item]]
    entries += [(item, f"own{item}-{k}".encode(), 2) for item in range(30) for k in range(5)]
    graph = lexical_rank.shared(entries)
    assert sum(len(own) for _, own in graph.items) + len(graph.sums) < len(entries) / 4
    # Unfolded, every item has its terms again, as often as they were.
    of_set = collections.defaultdict(list)
    for term, at in zip(graph.terms, graph.set_of.tolist()):
        of_set[at].append(term)

    def unfolded(node):
        return of_set[node] if node < graph.sets else [t for x in graph.sums[node - graph.sets] for t in unfolded(x)]

    again = [(item, t, times) for item, own in graph.items for node, times in own for t in unfolded(node)]
    assert sorted(again) == sorted(entries)


RUN = re.compile(r"[A-Za-zÀ-ÿ]+")


def plain_words(docs, every=97):
    counted = collections.Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = h % len(run)
            counted[run[:at] + run[at + 1 :] if h % every == 0 else run] += 1
    return {w: n for w, n in counted.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    out, forms = [], {}
    for word, n in words.items():
        others = [w for w in words if near(word, w)]
        form = min(others, key=lambda w: (-words[w], w), default=None)
        forms[word] = form if form and words[form] >= 2 * n else None
        out.append([word, forms[word], None, n, len(others), words[form] if forms[word] else None])
    for row in out:
        at = row[0]
        while forms[at]:
            at = forms[at]
        row[2] = at
    return sorted(map(tuple, out))


def test_variants_against_brute_force(spark):
    docs = [(i, t.replace("wort", "Wört") if t and i and i % 5 == 0 else t) for i, t in odd_rows()]
    words = plain_words(docs)
    found = spelling.variants(spelling.vocabulary(spelling.occurrences(frame(spark, docs).repartition(3))))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, found.collect())) == plain_variants(words)
    assert len(words) > 30 and any(r["root"] not in (r["word"], r["form"]) for r in found.collect())
    assert spelling.variants(spelling.vocabulary(spelling.occurrences(frame(spark, [])))).count() == 0


@pytest.mark.parametrize("block", [2, 7, 1000])
def test_hot_groups_are_halved_and_lose_no_pair(spark, block):
    draw = random.Random(9)
    words = {"".join(draw.choices("abé", k=draw.randint(5, 7))) for _ in range(250)}
    words |= {"prefix" + "".join(draw.choices("xy", k=5)) for _ in range(30)} | {"longer" * 12, "longer" * 12 + "s", "onger" + "longer" * 11}
    expected = {(a, b) for a in words for b in words if near(a, b)}
    table = spark.createDataFrame([(w,) for w in sorted(words)], "word string")
    found = [tuple(r) for r in spelling.near_words(table, block).collect()]
    assert set(found) == expected and len(found) == len(expected)
    largest = spelling.groups(table, block).where("s - head - tail > 1").agg(F.max(F.size("words"))).first()[0]
    assert largest is None or largest <= block


def test_bitsets_follow_one_error_at_any_place():
    words = ["straße", "strasse", "strase", "strafe", "traße", "straßen", "sträße", "sstraße", "aaaaa", "aaaaaa", "aaaaaaa"]
    found = {frozenset(p) for s in range(4, 9) for p in spelling.near_pairs([w for w in words if len(w) in (s, s + 1)], s, 0, 0)}
    assert found == {frozenset(p) for p in itertools.combinations(words, 2) if near(*p)}


def test_query_digests(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows = bpe_codec.op11_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: r["decoded_sha256"] for r in rows} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in docs}
