"""Near duplicates by BagMinHash.

A text is the bag of its five-word shingles, and two texts are near duplicates if their
weighted Jaccard similarity is 0.8 or more. A shingle's weight axis is cut at the powers
of two, [0, 1), [1, 2), [2, 4), ...; each piece has a Poisson process of its own, seeded
by shingle and piece, whose points have a time, a place in the piece and one of the
signature's components. A point counts if its place is below the shingle's count. The
first point in each component is the signature; two texts have the same one with a
probability of exactly their similarity. Times are drawn only up to a bound by which almost
every component has a point; the few texts that have one without are drawn again, further.

1. One pass makes, for each text, a key of its words and band hashes. Texts of the same words
   are one node, a number. Texts are not stored: a row is found again by its place in its Parquet file
   (rows from elsewhere, or that share a place, are copied first).
2. A bucket is the nodes with one band hash. Buckets of the same nodes are one, by their number and two sums
   of hashes, 128 bits. Only nodes that share a bucket have their texts read again, for their shingles.
3. A bucket is dealt into blocks by hash, of BLOCK nodes and BLOCK_BYTES of shingles at most, about.
   Within a block the multiset overlap of all pairs is counted exactly, as products of 0/1 matrices over the
   shingles that several nodes have; of the pairs that reach the threshold a spanning forest is
   kept, so a block gives fewer links than it has nodes. Links make components.
4. That is done for the first bands, and then for the others' buckets that have nodes of several components.
   A bucket of several blocks deals its nodes by a seed of its own, so near nodes of many buckets meet
   in some. Where it still has several components, its pairs of blocks are compared the same way,
   unless both blocks are all of one component. So no pair that shares a bucket is left out.

Hot groups: exact copies are one node; what is shuffled is in proportion to nodes and bands, but for
step 4, and never a row for a pair. Step 4 grows with the square of the blocks of a bucket
whose nodes are not all linked. No bucket is capped.

Defined cases: NULL and empty texts, and those without words, are like nothing, not even each
other; texts of fewer than five words have one shingle, all their words; rows that repeat
are one group; a group's class id is its least doc_id, NULL if all are NULL; an empty table
gives an empty table; other columns may have any name.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.byte_words import Words, mixed, runs_at, words_of
from lodeworks.llm.common import Scratch, numbered, sliced, small, table
from lodeworks.llm.common import keep as kept
from lodeworks.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
# 24 bands of 4: two texts of similarity 0.8 share a bucket but for 3 cases in a million.
BANDS, ROWS = 24, 4
SIZE = BANDS * ROWS
# The bands that are compared first; the others only where these leave several components.
FIRST_BANDS = 8
# Nodes and bytes of shingles that a block of a bucket holds, about.
BLOCK, BLOCK_BYTES = 512, 8 << 20
# Shingles that one matrix product counts.
COLUMNS = 4096
_SALT = np.uint64(0xA0761D6478BD642F)


def shingles(words: Words, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle and count, sorted by text and shingle."""
    lengths = np.diff(words.first)
    take = np.where(lengths >= SHINGLE, SHINGLE, lengths)
    owner = np.repeat(np.arange(texts), lengths)
    left = np.repeat(words.first[1:], lengths) - np.arange(len(owner))
    starts = np.flatnonzero(left >= take[owner])
    short = take[owner[starts]] < SHINGLE
    found = np.zeros(len(starts), np.uint64)
    found[~short] = runs_at(words.hashes, starts[~short], SHINGLE)
    for n in range(1, SHINGLE):
        of = np.flatnonzero(take[owner[starts]] == n)
        found[of] = runs_at(words.hashes, starts[of], n)
    owner = owner[starts]
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    new = np.ones(len(found), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
    first = np.flatnonzero(new)
    return owner[first], found[first], np.diff(np.append(first, len(found)))


def _points(owner: np.ndarray, shingle: np.ndarray, count: np.ndarray, until: np.ndarray, out: np.ndarray) -> None:
    """Draw all points up to `until` of each text; `out` keeps each component's first."""
    pieces = np.zeros(len(count), np.int64)
    while (open_ := count > (1 << pieces)).any():  # the pieces [2^(k-1), 2^k) that start below the count
        pieces[open_] += 1
    at = np.repeat(np.arange(len(count)), pieces + 1)
    piece = np.arange(len(at)) - np.repeat(np.cumsum(pieces + 1) - pieces - 1, pieces + 1)
    low = np.where(piece > 0, 1 << np.maximum(piece - 1, 0), 0)
    width = np.where(piece > 0, low, 1)
    state = mixed(shingle[at] ^ mixed(piece.astype(np.uint64) + _SALT))
    text, most, time = owner[at], count[at], np.zeros(len(at))
    limit = until[text]
    while len(state):
        state = mixed(state + _SALT)
        time = time - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (SIZE * width)
        on = time <= limit
        state, time, limit, text, most, low, width = (x[on] for x in (state, time, limit, text, most, low, width))
        draw = mixed(state ^ _SALT)
        place = low + (draw >> np.uint64(40)).astype(np.float64) * 2.0**-24 * width
        inside = place < most
        component = ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(SIZE) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(out, (text[inside], component[inside]), time[inside])


def signatures(owner: np.ndarray, shingle: np.ndarray, count: np.ndarray, texts: int) -> np.ndarray:
    """For each text the times of the first points, infinite if it has no shingle."""
    out = np.full((texts, SIZE), np.inf)
    total = np.bincount(owner, count, texts)
    factor = np.log(SIZE) + 4
    todo = total > 0
    while todo.any():
        until = np.where(todo, factor / np.maximum(total, 1), 0.0)
        mine = todo[owner]
        _points(owner[mine], shingle[mine], count[mine], until, out)
        todo &= np.isinf(out).any(axis=1)
        factor *= 3
    return out


def _keys(words: Words, texts: int) -> list[bytes | None]:
    """128 bits of a text's words in their order; None without words."""
    lengths = np.diff(words.first)
    place = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], lengths)
    halves = []
    for salt in (1, 2):
        one = mixed(words.hashes ^ mixed(place.astype(np.uint64) * np.uint64(4) + np.uint64(salt)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(one, dtype=np.uint64)])
        halves.append(mixed(sums[words.first[1:]] - sums[words.first[:-1]] + lengths.astype(np.uint64)))
    both = np.stack(halves, 1).astype(">u8")
    return [both[i].tobytes() if lengths[i] else None for i in range(texts)]


def _placed(docs: DataFrame, text: str = "text") -> DataFrame:
    """`_doc, _text, _row`; `_doc` has the other columns of `docs`, and `_row` is the same in every scan."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select((F.struct(*others) if others else F.lit(0)).alias("_doc"), F.col(f"`{text}`").alias("_text"))
    return numbered(rows, "near-docs")


def sketched(rows: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = kept) -> DataFrame:
    """`_row, _key, _n, _bands` of `_row, _text`, stored; texts are not."""
    schema = "_row bigint, _key binary, _n bigint, _bands array<bigint>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "_text"):
            n = batch.num_rows
            words = words_of(batch["_text"])
            owner, found, count = shingles(words, n)
            times = signatures(owner, found, count, n).view(np.uint64)
            bands = np.stack([runs_at(row, np.arange(0, SIZE, ROWS), ROWS) for row in times])
            bands = mixed(bands + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            keys = _keys(words, n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["_row"],
                    pa.array(keys, pa.binary()),
                    pa.array(np.bincount(owner, count, n).astype(np.int64)),
                    pa.array([b if k else None for b, k in zip(bands, keys)], pa.list_(pa.int64())),
                ],
                ["_row", "_key", "_n", "_bands"],
            )

    return keep(rows.select("_row", "_text").mapInArrow(scan, schema), "sketches")


def elements(words: Words, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and number of each shingle; the k-th time a text has it is a number of its own, so bags are sets."""
    owner, found, count = shingles(words, texts)
    again = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(owner, count), mixed(np.repeat(found, count) + again.astype(np.uint64) * _SALT)


def _bags(texts: DataFrame) -> DataFrame:
    """`node, n, bag` from `_row, _text`: the elements of each text, eight bytes each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "_text"):
            owner, found = elements(words_of(batch["_text"]), batch.num_rows)
            first = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            bags = pa.Array.from_buffers(
                pa.binary(), batch.num_rows, [None, pa.py_buffer((first * 8).astype(np.int32)), pa.py_buffer(found)]
            )
            yield pa.RecordBatch.from_arrays([batch["_row"], pa.array(np.diff(first)), bags], ["node", "n", "bag"])

    return texts.select("_row", "_text").mapInArrow(scan, "node long, n long, bag binary")


def alike(bags: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets of elements reach the threshold, as a matrix."""
    sizes = np.array([len(b) for b in bags])
    owner = np.repeat(np.arange(len(bags)), sizes)
    _, column, counts = np.unique(np.concatenate(bags), return_inverse=True, return_counts=True)
    several = counts > 1
    place = np.cumsum(several) - 1
    on = several[column]
    owner, column = owner[on], place[column[on]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(bags), len(bags)), np.float32)
    for low in range(0, int(several.sum()), COLUMNS):
        at = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        held = np.zeros((len(bags), COLUMNS), np.float32)
        held[owner[at], column[at] - low] = 1
        both += held @ held.T
    either = sizes[:, None] + sizes - both.astype(np.float64)
    return both / np.maximum(either, 1) >= threshold


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what `near` joins, fewer than nodes; from the first nodes outwards."""
    waiting, links = np.ones(len(near), bool), []
    for root in range(len(near)):
        if waiting[root]:
            waiting[root] = False
            front = deque([root])
            while front:
                at = front.popleft()
                new = np.flatnonzero(near[at] & waiting)
                waiting[new] = False
                links += [(at, x) for x in new.tolist()]
                front += new.tolist()
    return links


def _linked(rows: DataFrame, threshold: float) -> DataFrame:
    """`a, b`: links across labels in each group `_bucket, _lo, _hi` of `node, bag, label`."""

    def of_group(nodes: list, bags: list, labels: list) -> pa.RecordBatch | None:
        label = np.array(labels)
        if not len(label) or (label == label[0]).all():
            return None
        # In the order of the nodes, so that the forests of several buckets have the same links.
        order = np.argsort(np.array(nodes, np.int64), kind="stable")
        nodes, label = np.array(nodes, np.int64)[order], label[order]
        near = alike([np.frombuffer(bags[x], np.uint64) for x in order], threshold)
        links = forest(near & (label[:, None] != label))
        if not links:
            return None
        a, b = nodes[np.array(links)].T
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, ([], [], [])
        for batch in batches:
            keys = zip(*(batch[c].to_pylist() for c in ("_bucket", "_lo", "_hi")))
            rows = zip(*(batch[c].to_pylist() for c in ("node", "bag", "label")))
            for key, row in zip(keys, rows):
                if key != group:
                    if (out := of_group(*held)) is not None:
                        yield out
                    group, held = key, ([], [], [])
                for column, value in zip(held, row):
                    column.append(value)
        if (out := of_group(*held)) is not None:
            yield out

    key = ["_bucket", "_lo", "_hi"]
    dealt = rows.select(*key, "node", "bag", "label").repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(scan, "a long, b long")


def _buckets(placed: DataFrame) -> DataFrame:
    """`_bucket, _blocks` of the buckets of `_bucket, node, _n, label` with several labels, one of those with the same nodes."""
    own = F.xxhash64("node")
    sizes = placed.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("_size"), F.sum("_n").alias("_total"), F.bit_xor(own).alias("_x"),
        F.bit_xor(F.xxhash64(own, F.lit(1))).alias("_y"), F.min("label").alias("_low"), F.max("label").alias("_high"),
    )
    once = sizes.where("_low < _high").groupBy("_size", "_total", "_x", "_y").agg(F.min("_bucket").alias("_bucket"))
    blocks = F.greatest(F.ceil(F.col("_size") / BLOCK), F.ceil(F.col("_total") * 8 / BLOCK_BYTES)).cast("int")
    return once.select("_bucket", blocks.alias("_blocks"))


def _across(members: DataFrame) -> DataFrame:
    """`_bucket, _lo, _hi, node, label`: the nodes of each pair of blocks that are not all of one component."""
    spread = members.groupBy("_bucket", "_mine").agg(F.min("label").alias("_low"), F.max("label").alias("_high"))
    rows = members.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).where("_mine <> _other")
    rows = rows.withColumns({"_lo": F.least("_mine", "_other"), "_hi": F.greatest("_mine", "_other")})
    for side, name in (("_lo", "0"), ("_hi", "1")):
        own = spread.select("_bucket", F.col("_mine").alias(side), F.col("_low").alias(f"_l{name}"), F.col("_high").alias(f"_h{name}"))
        rows = rows.join(own, ["_bucket", side])
    return rows.where("least(_l0, _l1) < greatest(_h0, _h1)").select("_bucket", "_lo", "_hi", "node", "label")


def classes(
    stored: DataFrame, texts: DataFrame, threshold: float = THRESHOLD, keep: Callable[[DataFrame, str], DataFrame] = kept
) -> DataFrame:
    """`_key, _class` for the keys of what `sketched` gives for `texts`: the least node of each component."""
    nodes = keep(
        stored.where(F.col("_key").isNotNull()).groupBy("_key").agg(
            F.min("_row").alias("node"), F.first("_n").alias("_n"), F.first("_bands").alias("_bands")
        ),
        "nodes",
    )
    links = labels = None

    def labelled(rows: DataFrame) -> DataFrame:
        if labels is None:
            return rows.withColumn("label", F.col("node"))
        return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    def add(rows: DataFrame) -> None:
        nonlocal links, labels
        found = keep(_linked(rows.join(bags, "node"), threshold), "links")
        if links is None or not found.isEmpty():
            links = found if links is None else links.union(found)
            labels = components(links, keep)

    for first, bands in ((0, FIRST_BANDS), (FIRST_BANDS, BANDS - FIRST_BANDS)):
        placed = nodes.select("node", "_n", F.explode(F.slice("_bands", first + 1, bands)).alias("_bucket"))
        # Most buckets have one node; a count shuffles little, and only what is left goes on.
        shared = keep(placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1").select("_bucket"), "shared")
        placed = labelled(keep(placed.join(small(shared), "_bucket"), "shared-nodes"))
        buckets = keep(_buckets(placed), "buckets")
        mine = F.pmod(F.xxhash64("node", "_bucket"), F.col("_blocks")).cast("int")
        members = keep(placed.join(small(buckets), "_bucket").select("_bucket", "_blocks", "node", "label", mine.alias("_mine")), "members")
        candidates = small(members.select(F.col("node").alias("_row")).distinct())
        bags = keep(_bags(texts.select("_row", "_text").join(candidates, "_row")), "bags")
        add(members.select("_bucket", F.col("_mine").alias("_lo"), F.col("_mine").alias("_hi"), "node", "label"))
        # Buckets of several blocks that still have several components.
        apart = keep(_across(labelled(members.where("_blocks > 1").drop("label"))), "across")
        if not apart.isEmpty():
            add(apart)
    return nodes.select("_key", "node").join(labels, "node", "left").select("_key", F.coalesce("label", "node").alias("_class"))


def _classed(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """What `_placed` gives, and `_row, _class` of its rows; those without words have no class."""
    rows, scratch = _placed(docs, text), Scratch(docs.sparkSession)
    stored = sketched(rows, scratch.keep)
    if stored.count() > stored.select("_row").distinct().count():  # joined or exploded since they were read
        rows = kept(rows.withColumn("_row", F.monotonically_increasing_id()), "near-docs")
        stored = sketched(rows, scratch.keep)
    found = classes(stored, rows, keep=scratch.keep)
    named = kept(stored.select("_row", "_key").join(found, "_key", "left").select("_row", "_class"), "classes")
    scratch.clear()
    return rows, named


def _back(docs: DataFrame, text: str) -> list[Column]:
    """The columns of `docs` again."""
    return [F.col("_text").alias(c) if c == text else F.col("_doc").getField(c).alias(c) for c in docs.columns]


def grouped(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `_class`, a number for each group; rows without words have none."""
    docs = docs.drop("_class")
    placed, named = _classed(docs, text)
    return placed.join(named, "_row").select(*_back(docs, text), "_class")


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each group, that with the least doc_id; NULL is the largest."""
    placed, named = _classed(docs, text)
    rows = named.where(F.col("_class").isNotNull()).join(placed.select("_row", F.col("_doc").getField(doc_id).alias("_id")), "_row")
    best = rows.groupBy("_class").agg(
        F.count(F.lit(1)).alias("_of"), F.min(F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_row"))).alias("_best")
    )
    best = best.where("_of > 1").select("_class", F.col("_best._row").alias("_kept"))
    gone = kept(rows.join(best, "_class").where("_row <> _kept").select("_row"), "copies")
    return placed.join(small(gone), "_row", "left_anti").select(_back(docs, text))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed, named = _classed(docs, "text")
    ids = placed.select("_row", F.col("_doc.doc_id").alias("doc_id"))
    rows = kept(ids.join(named, "_row").select("doc_id", F.coalesce("_class", -1 - F.col("_row")).alias("_class")), "near-groups")
    sizes = rows.groupBy("_class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_docs"))
    return rows.join(sizes, "_class").select("doc_id", "class_id", "class_docs")
