"""Removing long byte strings that occur twice or more.

The dealt method, a distributed difference-cover suffix array, sorts a row for every byte of
the corpus several times; the README says what that would take. This operator finds the same
bytes by content anchors, exactly up to pairs of 64-bit hashes.

A repeat is a string of `length` bytes that also starts elsewhere. Of the GRAM-byte hashes
in such a string the least, the first of equals, is its anchor, so equal strings have equal anchors
at the same place. Every start of a string belongs to one anchor, and an anchor's starts are a run.

1. One pass makes a row per anchor (about one for 137 bytes): its hash, its run of starts, and a
   hash of the whole span that these strings cover.
2. Spans that occur twice repeat as a whole: a row for many bytes. This settles whole copies and
   the inside of shared passages.
3. What is left is anchors that others share with another span, as at the ends of passages. One
   of each such span is cut into pieces of PIECE starts by their distance from the anchor. All strings
   of a piece share a core; a piece whose core occurs once holds no repeat, and pieces that occur
   twice as a whole are settled like spans.
4. The few pieces left, which share a core with a different piece, are opened: a row for each of
   their starts, with the hash of its string. Equal ones are repeats.
5. Runs of repeated starts go back to their texts, which are cut in one pass.

Two strings count as equal if two 64-bit hashes agree: the anchor's and the span's, the core's and the
piece's, or the core's and the string's.

Hot strings: a row per anchor and copy, counted before it is shuffled; no pair is made.

Defined cases: NULL and empty texts have no bytes; texts under `length` bytes are kept whole;
repeated rows are copies of each other, and both lose what they share; overlapping strings of
one text count; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.llm.byte_words import mixed, powers, texts_of
from lodeworks.llm.common import Scratch, keep, scratch_path, sliced, table

LENGTH = 400
GRAM = 128
PIECE = 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
# A number for each byte.
_CODE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


class _Hashes:
    """Hashes of any pieces of some bytes."""

    def __init__(self, raw: np.ndarray) -> None:
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_CODE[raw] * powers(_BASE, len(raw)), out=self.sums[1:])
        self.back = powers(_INVERSE, len(raw) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, from least ones of half the width."""
    span, out = 1, keys
    while span * 2 <= width:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    n = len(keys) - width + 1
    return np.minimum(out[:n], out[width - span : width - span + n])


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Text, anchor, first and last start, hash of the anchor, hash of the span; places are in `raw`."""
    empty = np.zeros(0, np.int64)
    if len(raw) < length:
        return empty, empty, empty, empty, empty, empty
    hashes = _Hashes(raw)
    places = np.arange(len(raw) - GRAM + 1)
    grams = hashes.of(places, places + GRAM)
    bits = np.uint64(max(1, int(len(raw)).bit_length()))
    keys = ((grams >> bits) << bits) | places.astype(np.uint64)
    anchor = (_least(keys, length - GRAM + 1) & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    starts = np.arange(len(anchor))
    text = np.searchsorted(offsets, starts, "right") - 1
    ok = starts + length <= offsets[text + 1]
    starts, text, anchor = starts[ok], text[ok], anchor[ok]
    if not len(starts):
        return empty, empty, empty, empty, empty, empty
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    low, high, at = starts[first], starts[last], anchor[first]
    span = hashes.of(low, high + length) ^ mixed((at - low).astype(np.uint64) + np.uint64(1))
    return text[first], at, low, high, grams[at].view(np.int64), span.view(np.int64)


def _anchored(docs: DataFrame, length: int, text: str) -> DataFrame:
    """`_row, low, high, at, mark, whole`: an anchor's run of starts, in its text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text):
            raw, offsets = texts_of(batch[text])
            owner, at, low, high, mark, span = anchors(raw, offsets, length)
            places = [pa.array(x - offsets[owner]) for x in (low, high, at)]
            columns = [batch["_row"].take(pa.array(owner)), *places, pa.array(mark), pa.array(span)]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "low", "high", "at", "mark", "whole"])

    return docs.select("_row", text).mapInArrow(scan, "_row long, low long, high long, at long, mark long, whole long")


def _repeated(owner: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of `owner` as often as `counts` says: it, and a number from 0."""
    return np.repeat(owner, counts), np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _inside(runs: DataFrame, docs: DataFrame, text: str, cut_up: Callable[..., tuple[np.ndarray, ...]], schema: str) -> DataFrame:
    """What `cut_up(hashes, low, high, at, mark)` makes of the runs of some texts: the run's number, places, two hashes."""
    listed = F.sort_array(F.collect_list(F.struct("low", "high", "at", "mark")))
    wanted = runs.groupBy("_row").agg(listed.alias("_runs"))
    names = [f.split()[0] for f in schema.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text):
            raw, offsets = texts_of(batch[text])
            pairs, counts = batch["_runs"].flatten(), np.diff(batch["_runs"].offsets.to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), counts)
            first = offsets[owner]
            low, high, at = (pairs.field(i).to_numpy() + first for i in range(3))
            run, *places, one, other = cut_up(_Hashes(raw), low, high, at, pairs.field(3).to_numpy())
            places = [pa.array(x - first[run]) for x in places]
            yield pa.RecordBatch.from_arrays(
                [batch["_row"].take(pa.array(owner[run])), *places, pa.array(one), pa.array(other)], names
            )

    return docs.select("_row", text).join(wanted.hint("merge"), "_row").mapInArrow(scan, schema)


def _pieces(runs: DataFrame, docs: DataFrame, length: int, text: str) -> DataFrame:
    """`_row, low, high, at, mark, whole`: runs cut by distance from the anchor; `mark` is the core's hash."""

    def cut_up(hashes: _Hashes, low: np.ndarray, high: np.ndarray, at: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, ...]:
        nearest = (at - high) // PIECE
        run, k = _repeated(np.arange(len(low)), (at - low) // PIECE - nearest + 1)
        k = k + nearest[run]
        near = at[run] - k * PIECE
        first, last = np.maximum(low[run], near - PIECE + 1), np.minimum(high[run], near)
        core = hashes.of(near, near - PIECE + 1 + length) ^ mixed(k.astype(np.uint64) + np.uint64(1))
        whole = hashes.of(first, last + length) ^ mixed((at[run] - first).astype(np.uint64) + np.uint64(1))
        return run, first, last, at[run], core.view(np.int64), whole.view(np.int64)

    return _inside(runs, docs, text, cut_up, "_row long, low long, high long, at long, mark long, whole long")


def _starts(runs: DataFrame, docs: DataFrame, length: int, text: str) -> DataFrame:
    """`_row, start, mark, string`: a row for each start of the runs."""

    def cut_up(hashes: _Hashes, low: np.ndarray, high: np.ndarray, at: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, ...]:
        run, more = _repeated(np.arange(len(low)), high - low + 1)
        start = low[run] + more
        return run, start, mark[run], hashes.of(start, start + length).view(np.int64)

    return _inside(runs, docs, text, cut_up, "_row long, start long, mark long, string long")


def _settled(found: DataFrame, name: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Of runs with `mark, whole`: those that occur twice as a whole, and one of each that shares its mark with others."""
    wholes = found.groupBy("mark", "whole").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("_row", "low", "high", "at")).alias("one")
    )
    marks = wholes.groupBy("mark").agg(F.count(F.lit(1)).alias("wholes"), F.sum("n").alias("of_mark")).where("of_mark > 1")
    wholes = scratch.keep(wholes.join(marks, "mark"), name)
    twice = wholes.where("n > 1").select("mark", "whole").hint("merge")
    return (
        found.join(twice, ["mark", "whole"]).select("_row", "low", "high"),
        wholes.where("wholes > 1").select("one.*", "mark"),
    )


def repeats(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """`_row, low, high`: runs of starts of repeated strings in the texts of a stored table with `_row`."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.keep(_anchored(docs, length, text), "anchors")
    spans, shared = _settled(found, "spans", scratch)
    cut_up = scratch.keep(_pieces(shared, docs, length, text), "pieces")
    pieces, unlike = _settled(cut_up, "wholes", scratch)
    starts = scratch.keep(_starts(unlike, docs, length, text), "starts")
    equal = starts.groupBy("mark", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark", "string")
    single = starts.join(equal.hint("merge"), ["mark", "string"])
    single = single.select("_row", F.col("start").alias("low"), F.col("start").alias("high"))
    runs = keep(spans.union(pieces).union(single), "repeats")
    scratch.clear()
    return runs


def cut(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """`docs` with `kept`, the bytes that are left, `n_bytes`, `n_removed` and `n_spans`."""
    spark = docs.sparkSession
    path = scratch_path(spark, "suffix-docs")
    numbered = docs.withColumns({text: F.col(text).cast("binary"), "_row": F.monotonically_increasing_id()})
    numbered.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    runs = repeats(stored, length, text).groupBy("_row").agg(F.collect_list(F.struct("low", "high")).alias("_runs"))
    rows = stored.join(runs.hint("merge"), "_row", "left").drop("_row", "kept", "n_bytes", "n_removed", "n_spans")
    kept = [f for f in rows.schema if f.name not in ("_runs", text)]
    new = [T.StructField("kept", T.BinaryType()), *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]]
    schema = T.StructType([*kept, *new])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text):
            out = []
            for value, own in zip(batch[text], batch["_runs"]):
                raw = np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid else np.zeros(0, np.uint8)
                change = np.zeros(len(raw) + 1, np.int64)
                if own.is_valid:
                    np.add.at(change, own.values.field(0).to_numpy(), 1)
                    np.add.at(change, own.values.field(1).to_numpy() + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                n_spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (gone[:1].sum() if len(gone) else 0))
                out.append((raw[~gone].tobytes(), len(raw), int(gone.sum()), n_spans))
            columns = list(zip(*out)) if out else [()] * 4
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [*[batch[f.name] for f in kept], *[pa.array(c, k) for c, k in zip(columns, kinds)]], schema.names
            )

    return rows.mapInArrow(scan, schema)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cut(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
