"""Ranked lexical search for many queries at once, with their common subexpressions evaluated once.

1. Items, the queries, go through in blocks of bounded size. Terms that the same items hold
   equally often are one shared set; sets that follow one another in several items, the most
   frequent first, become a larger set, again and again, as a graph in which every
   node is the sum of two others. A set is a node once, however many items use it.
2. One scan of the documents counts, for the block's terms, how often each text has them. Terms
   are found by a perfect hash and compared byte for byte. The counts are stored; document
   frequencies, N and L are sums over them.
3. A task reads its share of the counts, fills the accumulators of the sets, which are numbers
   per document, adds up the graph from the bottom, and combines each item's nodes. Per
   item it keeps the `top` best documents, and these few rows alone are shuffled.

No pair of an item and a document is ever a row, and a hot source or term is spread as the files
are. Memory in a task: ACCUMULATOR_BYTES and one slice of texts.

Scores are exact 64-bit integers; ties go to the lower doc_id, NULL last, so reruns agree.

Defined cases: NULL and empty texts, of items or documents, have no terms; an item without
terms, or whose terms no text has, gives no row; repeated items are ranked each for itself,
repeated documents are each a candidate; an empty table on either side gives an empty
table; other columns of either table are not read. An item longer than a block is a
block of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodeworks.llm.bpe_codec import PerfectHash
from lodeworks.llm.byte_words import IN_WORD, LOWER, texts_of
from lodeworks.llm.common import ceil_div, discard, keep, scratch_path, sliced, table

TOP = 10
# (item, term) entries of a block, about.
BLOCK_ENTRIES = 50_000
ACCUMULATOR_BYTES = 32 << 20
SLICE_BYTES = 1 << 20


def spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the terms of texts that lie one after the other, and where each text's begin."""
    inside = IN_WORD[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    around = np.zeros(len(raw) + 2, bool)
    around[1:-1] = inside
    starts = np.flatnonzero(inside & (~around[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside & (~around[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def item_terms(items: DataFrame, text: str = "text") -> DataFrame:
    """`_item, term, repeats` of a table with `_item`."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text, SLICE_BYTES):
            raw, offsets = texts_of(batch[text])
            raw = LOWER[raw]
            starts, ends, first = spans(raw, offsets)
            data, found = raw.tobytes(), []
            for i, item in enumerate(batch["_item"].to_pylist()):
                own = slice(first[i], first[i + 1])
                counted = Counter(data[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist()))
                found += [(item, term, n) for term, n in counted.items()]
            columns = list(zip(*found)) or [(), (), ()]
            kinds = [pa.int64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["_item", "term", "repeats"])

    return items.select("_item", text).mapInArrow(scan, "_item long, term binary, repeats long")


@dataclass(frozen=True)
class Sharing:
    """A block's graph: nodes below `sets` are shared sets of terms, node `sets + i` is the sum of `sums[i]`."""

    terms: list[bytes]
    set_of: np.ndarray
    sets: int
    sums: list[tuple[int, int]]
    items: list[tuple[int, list[tuple[int, int]]]]  # item, its (node, times)


def shared(entries: list[tuple[int, bytes, int]]) -> Sharing:
    """Mine the sets of terms that items share, from `item, term, repeats`."""
    holders: dict[bytes, list[tuple[int, int]]] = {}
    for item, term, repeats in sorted(entries):
        holders.setdefault(term, []).append((item, repeats))
    terms = sorted(holders)
    # Terms that the same items hold equally often are one set; often held ones come first.
    listed = sorted({tuple(holders[t]) for t in terms}, key=lambda who: (-len(who), who))
    number = {who: at for at, who in enumerate(listed)}
    lists: dict[int, list[tuple[int, int]]] = {}
    for at, who in enumerate(listed):
        for item, repeats in who:
            lists.setdefault(item, []).append((at, repeats))
    sums: list[tuple[int, int]] = []
    while True:
        together = Counter(
            (a, b) for own in lists.values() for (a, r), (b, s) in zip(own, own[1:]) if r == s
        )
        chosen: dict[tuple[int, int], int] = {}
        taken: set[int] = set()
        for pair, n in sorted(together.items(), key=lambda x: (-x[1], x[0])):
            if n >= 2 and taken.isdisjoint(pair):
                taken.update(pair)
                chosen[pair] = len(listed) + len(sums)
                sums.append(pair)
        if not chosen:
            break
        for item, own in lists.items():
            out, i = [], 0
            while i < len(own):
                node = chosen.get((own[i][0], own[i + 1][0])) if i + 1 < len(own) and own[i][1] == own[i + 1][1] else None
                out.append(own[i] if node is None else (node, own[i][1]))
                i += 1 if node is None else 2
            lists[item] = out
    set_of = np.array([number[tuple(holders[t])] for t in terms], np.int64)
    return Sharing(terms, set_of, len(listed), sums, sorted(lists.items()))


def term_counts(docs: DataFrame, terms: PerfectHash, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, n, terms, counts`: a text's number of terms, and how often it has each of the block's."""
    found_by = docs.sparkSession.sparkContext.broadcast(terms)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = found_by.value
        for batch in sliced(batches, "text", SLICE_BYTES):
            raw, offsets = texts_of(batch["text"])
            raw = LOWER[raw]
            starts, ends, first = spans(raw, offsets)
            term = finder.find(np.concatenate([raw, np.zeros(8, np.uint8)]), starts, ends - starts)
            hit = np.flatnonzero(term >= 0)
            owner = np.searchsorted(first, hit, "right") - 1
            both, counts = np.unique(owner * np.int64(max(1, finder.n)) + term[hit], return_counts=True)
            owner, term = np.divmod(both, max(1, finder.n))
            places = (4 * np.searchsorted(owner, np.arange(batch.num_rows + 1))).astype(np.int32)
            packed = [
                pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(places), pa.py_buffer(x.astype("<u4"))])
                for x in (term, counts)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(np.diff(first)), *packed], ["doc_id", "n", "terms", "counts"]
            )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(scan, "doc_id long, n long, terms binary, counts binary")


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = texts_of(column)
    return np.frombuffer(raw.tobytes(), "<u4").astype(np.int64), offsets // 4


def frequencies(counted: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each of the block's terms is."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch["terms"])[0], minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for row in counted.select("terms").mapInArrow(scan, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out


def _kept(best: tuple, scores: np.ndarray, ids: np.ndarray, null: np.ndarray, top: int) -> tuple:
    """The `top` first of two lists by score, then id, NULL last."""
    scores, ids, null = (np.concatenate([a, b]) for a, b in zip(best, (scores, ids, null)))
    order = np.lexsort((ids, null, -scores))[:top]
    return scores[order], ids[order], null[order]


def best_documents(counted: DataFrame, graph: Sharing, weights: np.ndarray, N: int, L: int, top: int) -> DataFrame:
    """`_item, score, doc_id`: each task's `top` best documents of each item."""
    given = counted.sparkSession.sparkContext.broadcast((graph, weights))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weights = given.value
        nodes = graph.sets + len(graph.sums)
        width = max(1, ACCUMULATOR_BYTES // (8 * max(1, nodes)))
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        best = {item: none for item, _ in graph.items}
        for whole in batches:
            for low in range(0, whole.num_rows, width):
                batch = whole.slice(low, width)
                term, first = _numbers(batch["terms"])
                tf, _ = _numbers(batch["counts"])
                n = batch["n"].to_numpy()
                owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
                m = 100 - 75 + (75 * n * N) // max(1, L)
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
                sums = np.zeros((nodes, batch.num_rows), np.int64)
                np.add.at(sums, (graph.set_of[term], owner), value)
                for at, (a, b) in enumerate(graph.sums, graph.sets):
                    np.add(sums[a], sums[b], out=sums[at])
                null = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
                ids = batch["doc_id"].fill_null(0).to_numpy()
                score = np.empty(batch.num_rows, np.int64)
                for item, own in graph.items:
                    score[:] = 0
                    for node, times in own:
                        score += sums[node] if times == 1 else times * sums[node]
                    least = max(1, best[item][0][-1]) if len(best[item][0]) == top else 1
                    at = np.flatnonzero(score >= least)
                    if len(at):
                        best[item] = _kept(best[item], score[at], ids[at], null[at], top)
        for item, (scores, ids, null) in best.items():
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(scores), item)), pa.array(scores), pa.array(ids, mask=null)], ["_item", "score", "doc_id"]
                )

    return counted.mapInArrow(scan, "_item long, score long, doc_id long")


def ranked(
    docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    block_entries: int = BLOCK_ENTRIES,
) -> DataFrame:
    """`item_id, rank, doc_id, score`: each item's best documents, rank 1 the highest."""
    spark = docs.sparkSession
    numbered = keep(items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).withColumn("_item", F.monotonically_increasing_id()), "items")
    terms = item_terms(numbered)
    sizes = terms.groupBy("_item").agg(F.count(F.lit(1)).alias("_n"))
    blocks = max(1, ceil_div(sizes.agg(F.sum("_n")).first()[0] or 0, block_entries))
    terms = keep(terms.withColumn("_block", F.pmod(F.xxhash64("_item"), F.lit(blocks)).cast("int")), "item-terms")
    found: DataFrame | None = None
    for block in range(blocks):
        entries = [tuple(r) for r in terms.where(F.col("_block") == block).select("_item", "term", "repeats").toLocalIterator()]
        graph = shared([(item, bytes(term), repeats) for item, term, repeats in entries])
        finder = PerfectHash(graph.terms)
        path = scratch_path(spark, "term-counts")
        rows = term_counts(docs, finder, doc_id, text)
        rows.write.option("compression", "zstd").parquet(path)
        counted = spark.read.schema(rows.schema).parquet(path)
        total = counted.where("n > 0").agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
        N, L = total["N"], total["L"] or 0
        df = frequencies(counted, len(graph.terms))
        weights = np.array([math.floor(1000 * math.log((2 * N + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        best = keep(best_documents(counted, graph, weights, N, L, top), "best")
        discard(spark, path)
        found = best if found is None else found.union(best)
    order = W.partitionBy("_item").orderBy(F.desc("score"), F.col("doc_id").isNull(), "doc_id")
    first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(numbered.drop("text"), "_item").select("item_id", "rank", "doc_id", "score")


def op12_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), s AS (
  SELECT count(*)::BIGINT AS all_docs, sum(len(ws))::BIGINT AS all_terms FROM d WHERE len(ws) > 0
), q AS (
  SELECT iid, term, count(*) AS r FROM (SELECT iid, unnest(ws) AS term FROM b) GROUP BY ALL
), t AS (
  SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(ws) AS n, unnest(ws) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM t, s GROUP BY term, all_docs
), v AS (
  SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * all_docs) // all_terms)))) AS v
  FROM t JOIN w USING (term), s
), x AS (
  SELECT iid, rid, doc_id, sum(r * v)::BIGINT AS score FROM q JOIN v USING (term) GROUP BY ALL HAVING sum(r * v) > 0
), k AS (
  SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM x
)
SELECT item_id, rank, doc_id, score FROM k JOIN b USING (iid) WHERE rank <= 10
"""
