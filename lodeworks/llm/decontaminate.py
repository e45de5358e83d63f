"""Benchmark decontamination by winnowing.

An item's windows are its runs of 10 words. Of the 5-word hashes in a row of 6, the
least is a fingerprint, on both sides; ten shared words hold six shared hashes, so every
shared window has a shared fingerprint. Fingerprints of the documents are looked up among
the items', and a hit is extended: the windows around it are looked up whole, by 128 bits
of hash. An item of fewer words is one window, and all runs of that length are fingerprints.

The items' fingerprints and windows are small and are broadcast, in blocks of at most
MAX_WINDOWS: a larger benchmark takes more passes over the documents, each stored before
the next, and gives the same result. Documents stay where they are: no shuffle, and a passage
that many of them share costs each of them the same.

Defined cases: NULL and empty texts have no words, are clean as documents and give no window
as items; repeated rows are judged one by one; items that repeat an id count once, a NULL
id is the empty string; an empty benchmark leaves everything clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.llm.byte_words import covered, runs, runs_at, words_of
from lodeworks.llm.common import ceil_div, keep, sliced, table

# Fixed value: words of a window.
WINDOW = 10
# Words of a hash and hashes in a row; GRAM + ROW - 1 = WINDOW.
GRAM, ROW = 5, 6
# Windows of one broadcast block, about 40 bytes each.
MAX_WINDOWS = 2_000_000


def _grams(length: int) -> tuple[int, int]:
    return (GRAM, ROW) if length == WINDOW else (length, 1)


def _within(first: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n words start a run of `length` that ends in the same text."""
    left = np.repeat(first[1:], np.diff(first)) - np.arange(first[0], first[-1])
    return (left >= length)[:n]


def _winnowed(grams: np.ndarray, valid: np.ndarray, row: int) -> np.ndarray:
    """Which hashes are the least in one of the rows that start at `valid` places."""
    n = max(0, len(grams) - row + 1)
    valid = valid[:n]
    least = grams[:n].copy()
    for k in range(1, row):
        np.minimum(least, grams[k : k + n], out=least)
    chosen = np.zeros(len(grams), bool)
    for k in range(row):
        chosen[k : k + n] |= valid & (grams[k : k + n] == least)
    return chosen


def fingerprints(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """`item, length, mark, other`: fingerprints of the items where `other` is NULL, else windows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            words = words_of(batch["text"])
            counts = np.diff(words.first)
            owner = np.repeat(np.arange(batch.num_rows), counts)
            of_length = np.minimum(counts, WINDOW)[owner] if len(owner) else owner
            out = []
            for length in np.unique(of_length):
                gram, row = _grams(int(length))
                valid = _within(words.first, length, len(owner)) & (of_length == length)
                starts = np.flatnonzero(valid)
                grams = runs(words.hashes, gram)
                marks = np.flatnonzero(_winnowed(grams, valid, row))
                for at, mark, other in (
                    (marks, grams[marks], None),
                    (starts, runs(words.hashes, int(length))[starts], runs(words.hashes, int(length), 1)[starts]),
                ):
                    out.append(
                        pa.RecordBatch.from_arrays(
                            [
                                batch["item"].take(pa.array(owner[at])),
                                pa.array(np.full(len(at), length, np.int32)),
                                pa.array(mark.view(np.int64)),
                                pa.nulls(len(at), pa.int64()) if other is None else pa.array(other.view(np.int64)),
                            ],
                            ["item", "length", "mark", "other"],
                        )
                    )
            yield from out

    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(scan, "item string, length int, mark long, other long").distinct()


class _Block:
    """What the tasks look up: by length, fingerprints and windows, sorted, and the windows' items."""

    def __init__(self, rows: pa.Table) -> None:
        self.by_length: dict[int, tuple] = {}
        lengths = rows["length"].to_numpy()
        mark, is_mark = rows["mark"].to_numpy().view(np.uint64), rows["other"].is_null().to_numpy()
        other = rows["other"].fill_null(0).to_numpy().view(np.uint64)
        names = rows["item"].combine_chunks()
        for length in np.unique(lengths):
            marks = np.unique(mark[(lengths == length) & is_mark])
            seen = np.zeros(1 << 20, bool)
            seen[marks & np.uint64(len(seen) - 1)] = True
            at = np.flatnonzero((lengths == length) & ~is_mark)
            at = at[np.lexsort((other[at], mark[at]))]
            self.by_length[int(length)] = seen, marks, mark[at], other[at], names.take(pa.array(at))

    def windows(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
        """By length: where windows of items start, and for each the range of its items."""
        for length, (seen, marks, mark, other, names) in self.by_length.items():
            gram, row = _grams(length)
            valid = _within(first, length, len(hashes))
            grams = runs(hashes, gram)
            hit = np.flatnonzero(_winnowed(grams, valid, row))
            hit = hit[seen[grams[hit] & np.uint64(len(seen) - 1)]]
            hit = hit[_found(marks, grams[hit])]
            # Extend: every window that holds the fingerprint.
            starts = np.unique((hit[:, None] - np.arange(row)).ravel())
            starts = starts[starts >= 0]
            starts = starts[valid[starts]]
            one, two = (runs_at(hashes, starts, length, salt) for salt in (0, 1))
            low, high = np.searchsorted(mark, one, "left"), np.searchsorted(mark, one, "right")
            ok = high > low
            starts, low, high, two = starts[ok], low[ok], high[ok], two[ok]
            ranges = np.array(
                [(a + np.searchsorted(other[a:b], t, "left"), a + np.searchsorted(other[a:b], t, "right")) for a, b, t in zip(low, high, two)],
                np.int64,
            ).reshape(-1, 2)
            ok = ranges[:, 1] > ranges[:, 0]
            yield length, starts[ok], ranges[ok], names


def _found(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _spans(mask: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True within each text: starts and ends, and how many numbers each text has of both."""
    edge = np.zeros(len(mask) + 1, bool)
    edge[first] = True
    before = np.concatenate([[False], mask])
    starts = np.flatnonzero(mask & (~before[:-1] | edge[:-1]))
    after = np.concatenate([mask, [False]])
    ends = np.flatnonzero(mask & (~after[1:] | edge[1:])) + 1
    owner = np.searchsorted(first, starts, "right") - 1
    flat = np.stack([starts - first[owner], ends - first[owner]], 1).ravel().astype(np.int32)
    return flat, np.concatenate([[0], 2 * np.cumsum(np.bincount(owner, minlength=len(first) - 1))]).astype(np.int32)


def _pass(docs: DataFrame, block: _Block, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    schema = docs.schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in sliced(batches, text):
            words = words_of(batch[text])
            mask = np.zeros(len(words.hashes), bool)
            items: dict[int, set[str]] = {}
            for i, flat in enumerate(batch["spans"].to_pylist()):
                for a, b in zip(flat[::2], flat[1::2]):
                    mask[words.first[i] + a : words.first[i] + b] = True
            for i, old in enumerate(batch["items"].to_pylist()):
                if old:
                    items[i] = set(old)
            for length, starts, ranges, names in known.windows(words.hashes, words.first):
                mask |= covered(starts, length, len(mask))
                owners = np.searchsorted(words.first, starts, "right") - 1
                pairs = np.unique(np.column_stack([owners, ranges]), axis=0)
                for owner, a, b in pairs.tolist():
                    items.setdefault(owner, set()).update(names.slice(a, b - a).to_pylist())
            flat, offsets = _spans(mask, words.first)
            new = {
                "n_words": pa.array(np.diff(words.first).astype(np.int64)),
                "spans": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                "items": pa.array([sorted(items.get(i, ())) for i in range(batch.num_rows)], pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays([new.get(f.name, batch[f.name]) for f in schema], [f.name for f in schema])

    return docs.mapInArrow(scan, schema)


def matched(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """`docs` with `n_words`; `spans`, the starts and ends of the hit runs of words; and `items`."""
    known = keep(fingerprints(benchmark, item), "benchmark-windows")
    blocks = max(1, ceil_div(known.count(), max_windows))
    fresh = {
        "n_words": F.lit(0).cast("bigint"),
        "spans": F.array().cast(T.ArrayType(T.IntegerType())),
        "items": F.array().cast(T.ArrayType(T.StringType())),
    }
    found = docs.withColumns(fresh)
    for i in range(blocks):
        block = _Block(known.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i).toArrow())
        found = _pass(found if i == 0 else keep(found, "benchmark-pass"), block, text)
    return found


def digest(found: DataFrame) -> DataFrame:
    hit = F.aggregate(
        F.sequence(F.lit(0), F.size("spans") - 2, F.lit(2)),
        F.lit(0).cast("bigint"),
        lambda n, i: n + F.get("spans", i + 1) - F.get("spans", i),
    )
    n_hit = F.when(F.size("spans") > 0, hit).otherwise(F.lit(0).cast("bigint"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(matched(docs, table(spark, sf_dir, "benchmark")).drop("text"))


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), bw AS (
  SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT item, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)
), dw AS (
  SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)
), h AS (
  SELECT rid, n, i, item FROM dw JOIN bw USING (n, g)
), hit AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM h) GROUP BY rid
), it AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""
