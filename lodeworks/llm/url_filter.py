"""URL filters by a cascade of Bloom filters.

The first filter holds the listed keys, the second the keys of the corpus that pass
the first by mistake, the third the listed keys that pass the second, and so on until
nothing passes. For every key of the corpus the first filter that it fails tells
exactly whether it is listed, so pages are judged in the scan: no join and no exact list.

Keys of a url: every suffix of its host, by labels, with every start of its path that
is as long as the path of some rule; and the words of its host. The listed keys are
the rules (one cascade for those that allow, one for those that block) and the words
that mark a host as unwanted.

Cost: one shuffle of the distinct keys of the corpus, then passes over those that are
left, which shrink from level to level. What is broadcast is the filters: their size
follows from the number of listed keys and is checked against MAX_BITS.

Defined cases: a NULL url, or one without `://`, has an empty host and path and is
allowed; of rules of equal length the one with the longer host wins, then the smaller
string; repeated rows are judged one by one; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.llm.common import keep, table

# The rules of the query.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
# Host words of unwanted sites, between dots and hyphens.
HOST_WORDS = ["adult", "casino", "porn", "spam", "xxx"]

# Bits of one filter at most: 32 MB.
MAX_BITS = 1 << 28
MIN_BITS, MAX_HASHES = 1024, 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _positions(h1: np.ndarray, h2: np.ndarray, depth: int, hashes: int, bits: int) -> Iterator[np.ndarray]:
    """The bits of each key, others at each level, or what passes one would pass all."""
    salt = np.uint64(depth + 1) * np.uint64(0x9E3779B97F4A7C15)
    step = ((h2 ^ salt) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(20)
    at = (h1 ^ (h1 >> np.uint64(31)) ^ salt) * np.uint64(0xBF58476D1CE4E5B9)
    for i in range(hashes):
        yield ((at + np.uint64(i) * step) >> np.uint64(8)) % np.uint64(bits)


@dataclass(frozen=True)
class Level:
    depth: int
    hashes: int
    words: np.ndarray

    def passes(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.ones(len(h1), bool)
        for at in _positions(h1, h2, self.depth, self.hashes, len(self.words) * 64):
            found &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


@dataclass(frozen=True)
class Cascade:
    """Exact membership for the keys it was built over."""

    levels: list[Level]

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        listed, open_ = np.zeros(len(h1), bool), np.arange(len(h1))
        for depth, level in enumerate(self.levels):
            ok = level.passes(h1[open_], h2[open_])
            listed[open_[~ok]] = depth % 2 == 1
            open_ = open_[ok]
        listed[open_] = len(self.levels) % 2 == 1
        return listed


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(2))


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _through(keys: DataFrame, level: Level) -> DataFrame:
    """The keys that pass a level."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(level.passes(_unsigned(batch["h1"]), _unsigned(batch["h2"]))))

    return keys.mapInArrow(scan, keys.schema)


def _filter_of(keys: DataFrame, count: int, rate: float, depth: int) -> Level:
    """A Bloom filter: bits set in the tasks, joined by word, brought back as m / 64 numbers."""
    bits = max(MIN_BITS, math.ceil(count * -math.log(rate) / math.log(2) ** 2 / 64) * 64)
    if bits > MAX_BITS:
        raise ValueError(f"{count} listed keys need a filter of {bits} bits; the limit is {MAX_BITS}: split the list by host")
    hashes = min(MAX_HASHES, max(1, round(bits / count * math.log(2))))

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = _unsigned(batch["h1"]), _unsigned(batch["h2"])
            at = np.unique(np.concatenate(list(_positions(h1, h2, depth, hashes, bits))))
            word, bit = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
            names, first = np.unique(word, return_index=True)
            joined = np.bitwise_or.reduceat(bit, first) if len(first) else bit
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(joined.view(np.int64))], ["w", "v"])

    found = keys.select("h1", "h2").mapInArrow(positions, "w long, v long").groupBy("w").agg(F.bit_or("v").alias("v")).toPandas()
    words = np.zeros(bits // 64, np.uint64)
    words[found["w"].to_numpy(np.int64)] = found["v"].to_numpy(np.int64).view(np.uint64)
    return Level(depth, hashes, words)


def cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Levels for `listed` over `universe`, both with a string column `key`; NULL keys are left out.

    `universe` must have every key that will be looked up; it is read once.
    """
    ours = listed.where(F.col("key").isNotNull()).select("key").distinct()
    h1, h2 = _hashes(F.col("key"))
    inside = keep(ours.select(h1.alias("h1"), h2.alias("h2")), "cascade-listed")
    outside = universe.where(F.col("key").isNotNull()).join(ours, "key", "left_anti").select(h1.alias("h1"), h2.alias("h2"))
    outside = keep(outside, "cascade-rest")
    sides, counts, levels = [inside, outside], [inside.count(), outside.count()], []
    while counts[0]:
        rate = 0.5 if levels else min(0.5, counts[0] / (math.sqrt(2) * max(1, counts[1])))
        levels.append(_filter_of(sides[0], counts[0], rate, len(levels)))
        passed = keep(_through(sides[1], levels[-1]), "cascade-level")
        # What passed by mistake is what the next filter has to hold.
        sides, counts = [passed, sides[0]], [passed.count(), counts[0]]
    return Cascade(levels)


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    start = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def keys_of(host: Column, path: Column, path_lengths: Sequence[int]) -> Column:
    """All keys of a url, distinct."""
    labels = F.split(host, r"\.")
    names = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    lengths = F.filter(F.array(*[F.lit(n) for n in path_lengths]), lambda n: n <= F.length(path))
    rules = F.flatten(F.transform(names, lambda s: F.transform(lengths, lambda n: F.concat(F.lit("r:"), s, F.substring(path, F.lit(1), n)))))
    words = F.transform(F.split(host, r"[.\-]"), lambda w: F.concat(F.lit("w:"), w))
    return F.array_distinct(F.concat(rules, words))


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, host_words: Sequence[str] = HOST_WORDS, url: str = "url"
) -> DataFrame:
    """`pages` with `host, path, rule, verdict`."""
    spark = pages.sparkSession
    lengths = sorted({len(r) - (r.find("/") if "/" in r else len(r)) for _, r in rules})
    host, path = parts(F.col(url))
    split = pages.withColumns({"host": host, "path": path})
    keyed = split.withColumn("_keys", keys_of(F.col("host"), F.col("path"), lengths))
    universe = keep(keyed.select(F.explode("_keys").alias("key")).distinct(), "url-keys")

    def listed(keys: list[str]) -> DataFrame:
        return spark.createDataFrame([(k,) for k in keys], "key string")

    lists = {
        "allow": [f"r:{r}" for verdict, r in rules if verdict == "allow"],
        "block": [f"r:{r}" for verdict, r in rules if verdict == "block"],
        "word": [f"w:{w}" for w in host_words],
    }
    shared = spark.sparkContext.broadcast({name: cascade(listed(keys), universe) for name, keys in lists.items()})

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascades = shared.value
        for batch in batches:
            keys = batch["_keys"]
            flat, ends = keys.flatten(), np.diff(keys.offsets.to_numpy())
            owner = np.repeat(np.arange(len(ends)), ends)
            h1, h2 = _unsigned(batch["_h1"].flatten()), _unsigned(batch["_h2"].flatten())
            rule, verdict = [None] * batch.num_rows, ["allow"] * batch.num_rows
            best = [(0, 0, "")] * batch.num_rows
            for i in np.flatnonzero(cascades["word"].contains(h1, h2)):
                verdict[owner[i]] = "block"
            for side in ("allow", "block"):
                for i in np.flatnonzero(cascades[side].contains(h1, h2)):
                    at, text = owner[i], flat[int(i)].as_py()[2:]
                    rank = (-len(text), -(text.find("/") if "/" in text else len(text)), text)
                    if rule[at] is None or rank < best[at]:
                        rule[at], verdict[at], best[at] = text, side, rank
            kept = batch.drop_columns(["_keys", "_h1", "_h2"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                [*kept.schema.names, "rule", "verdict"],
            )

    one = F.transform("_keys", lambda k: _hashes(k)[0])
    two = F.transform("_keys", lambda k: _hashes(k)[1])
    plain = keyed.drop("rule", "verdict")
    schema = T.StructType(
        [*plain.drop("_keys").schema, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]
    )
    return plain.withColumns({"_h1": one, "_h2": two}).mapInArrow(judge, schema)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
WITH a AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), b AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a
), c AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b
), r(verdict, rule, rhost, rpath) AS (
  VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
    ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
    ('block', 'com/de/', 'com', '/de/')
), m AS (
  SELECT DISTINCT c.host, c.path, first(r.rule ORDER BY length(rule) DESC) AS rule,
    first(r.verdict ORDER BY length(rule) DESC) AS verdict
  FROM (SELECT DISTINCT host, path FROM c) AS c JOIN r
    ON (c.host = rhost OR ends_with(c.host, '.' || rhost)) AND starts_with(c.path, rpath)
  GROUP BY c.host, c.path
)
SELECT page_id, c.host, c.path, m.rule,
  coalesce(m.verdict, CASE WHEN list_has_any(regexp_split_to_array(c.host, '[.\-]'), ['adult', 'casino', 'porn', 'spam', 'xxx'])
    THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN m ON c.host = m.host AND c.path = m.path
"""
