"""Quality grades by ordinal regression.

A text's score is the sum of shared weights over its features: its distinct words, the
distinct beginnings of its words, both hashed, and steps of a few measures (length, shares
of capitals, signs and digits, how often words repeat). A cumulative-link model puts ordered
thresholds on the score: P(grade <= g) = logistic(threshold g - score). Expected grade and the
probability of the top grade follow; the latter selects.

The model is fitted on a bounded, documented sample of the labelled rows: the first LABELLED rows
by a hash of doc_id, all if there are fewer; one tenth by another hash is left out for measuring.
Tasks run AdaGrad over their part of the sample and their weights are averaged, a few
times. What comes to the driver is the changed weights, PARTS times 2^BITS numbers a round at
most, whatever the size of the corpus. All documents are then scored where they are, without a shuffle.

Grades from the labels: 0 for bad quality, 1 for good but toxic, 2 for good.

Defined cases: a NULL or empty text has the features of length 0 alone; labels with a NULL and
labels of unknown documents are left out; repeated labels count once, and different ones of a document are
a row each; of documents to learn from that share an id the least text is taken; repeated rows are scored one
by one; input columns named like the new ones are replaced; without labels every score is 0 and the thresholds are those of no knowledge.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.llm.byte_words import texts_of, words_of
from lodeworks.llm.common import keep, sliced, table

GRADES = 3
BITS = 18
HEAD = 4
# A feature learns if it is in so many rows of a part and its share of some grade differs from
# the part's by so many standard deviations. Others would only help texts to learn themselves.
MIN_ROWS, MIN_DEVIATIONS = 8, 7.0
# The bound of the sample that the model is fitted on, in rows.
LABELLED = 20_000
PARTS, ROUNDS, EPOCHS, BATCH = 4, 4, 4, 32
RATE, SHRINK = 0.2, 1e-4
MIN_TOP = 0.7
STEPS = 16


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def below(self, score: np.ndarray) -> np.ndarray:
        """P(grade <= g) for g below the top: one column for each threshold."""
        return 1 / (1 + np.exp(np.clip(score[:, None] - self.thresholds[None, :], -50, 50)))

    def judge(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and probability of the top grade."""
        below = self.below(score)
        return (1 - below).sum(axis=1), 1 - below[:, -1]


def _measures(column: pa.Array, lengths: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """A step number for each text and measure."""
    raw, offsets = texts_of(column)
    kinds = np.zeros(256, np.uint8)
    kinds[ord("A") : ord("Z") + 1], kinds[ord("0") : ord("9") + 1] = 1, 2
    kinds[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ",.'\"-"]] = 3
    kind, size = kinds[raw], np.maximum(np.diff(offsets), 1)
    out = [np.minimum(np.log2(lengths + 1), STEPS - 1)]
    for k in (1, 2, 3):
        sums = np.concatenate([[0], np.cumsum(kind == k)])
        share = (sums[offsets[1:]] - sums[offsets[:-1]]) / size
        out.append(np.minimum(share * 40, STEPS - 1))
    out.append((1 - distinct / np.maximum(lengths, 1)) * (STEPS - 1))
    out.append(np.minimum(np.diff(offsets) / np.maximum(lengths, 1), STEPS - 1))
    return np.stack(out, 1).astype(np.int64)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text and feature, each pair once; features below the last 1024 are hashed."""
    n, hashed = len(column), (1 << BITS) - 1024
    words = words_of(column, HEAD)
    lengths = np.diff(words.first)
    owner = np.repeat(np.arange(n, dtype=np.uint64), lengths)
    whole = np.unique((owner << np.uint64(BITS)) | (words.hashes % np.uint64(hashed)))
    distinct = np.bincount((whole >> np.uint64(BITS)).astype(np.int64), minlength=n)
    heads = np.unique((owner << np.uint64(BITS)) | ((words.heads >> np.uint64(7)) % np.uint64(hashed)))
    steps = _measures(column, lengths, distinct)
    places = np.arange(steps.shape[1]) * STEPS + hashed + steps
    rows = np.repeat(np.arange(n), steps.shape[1])
    mask = np.uint64((1 << BITS) - 1)
    text = np.concatenate([(whole >> np.uint64(BITS)).astype(np.int64), (heads >> np.uint64(BITS)).astype(np.int64), rows])
    feature = np.concatenate([(whole & mask).astype(np.int64), (heads & mask).astype(np.int64), places.ravel()])
    return text, feature


def _fold(doc_id: str = "doc_id"):
    return F.pmod(F.xxhash64(F.col(doc_id), F.lit(7)), F.lit(10))


def graded(labels: DataFrame) -> DataFrame:
    """`doc_id, grade`, each once: labels that say the same of a document count as one."""
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return known.select("doc_id", grade.cast("int").alias("grade")).distinct()


def examples(docs: DataFrame, grades: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """`doc_id, grade, features`, stored: `labelled` rows outside of fold 0, or all if there are fewer.

    The rows drawn are the first by a hash, so reruns agree. Repeated grades of a document are one row, and of
    documents that repeat an id the least text is taken, so neither adds rows beyond the bound.
    """
    grades = grades.distinct().where(_fold() != 0)
    drawn = grades.orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id", "grade").limit(labelled)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            text, feature = features(batch["text"])
            order = np.argsort(text, kind="stable")
            offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=batch.num_rows))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(feature[order].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["grade"], lists], ["doc_id", "grade", "features"])

    # Bounded by `labelled`, so a broadcast; the texts of other documents go no further.
    joined = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    joined = joined.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    return keep(joined.select("doc_id", "grade", "text").mapInArrow(scan, "doc_id long, grade int, features array<int>"), "examples")


def _telling(grades: np.ndarray, lists: list[np.ndarray], size: int) -> np.ndarray:
    """Which features say something about the grade."""
    flat, owner = np.concatenate(lists), np.repeat(grades, [len(x) for x in lists])
    rows = np.bincount(flat, minlength=size)
    far = np.zeros(size)
    for g in range(GRADES):
        share = (grades == g).mean()
        spread = np.sqrt(np.maximum(rows * share * (1 - share), 1e-9))
        far = np.maximum(far, np.abs(np.bincount(flat[owner == g], minlength=size) - rows * share) / spread)
    return (rows >= MIN_ROWS) & (far >= MIN_DEVIATIONS)


def _learn(model: Model, grades: np.ndarray, lists: list[np.ndarray], seed: int) -> Model:
    """AdaGrad from `model` on over one part of the sample."""
    weights, raw = model.weights.copy(), model.thresholds.copy()
    telling = _telling(grades, lists, len(weights))
    lists = [x[telling[x]] for x in lists]
    seen, seen_raw = np.full(len(weights), 1e-2, np.float32), np.full(len(raw), 1e-2)
    draw = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = draw.permutation(len(grades))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            counts = np.array([len(lists[i]) for i in rows])
            flat, owner, y = np.concatenate([lists[i] for i in rows]), np.repeat(np.arange(len(rows)), counts), grades[rows]
            score = np.bincount(owner, weights[flat], len(rows))
            below = Model(weights, raw).below(score)
            upper = np.column_stack([below, np.ones(len(rows))])[np.arange(len(rows)), y]
            lower = np.column_stack([np.zeros(len(rows)), below])[np.arange(len(rows)), y]
            slope = 1 - upper - lower  # of the loss by the score
            chance = np.maximum(upper - lower, 1e-9)
            step_raw = np.zeros(len(raw))
            for g in range(len(raw)):
                dense = below[:, g] * (1 - below[:, g]) / chance
                step_raw[g] = (dense * (y == g + 1)).sum() - (dense * (y == g)).sum()
            touched, inverse = np.unique(flat, return_inverse=True)
            gradient = np.bincount(inverse, slope[owner], len(touched)) + SHRINK * weights[touched]
            seen[touched] += gradient**2
            weights[touched] -= RATE * gradient / np.sqrt(seen[touched])
            seen_raw += step_raw**2
            raw = np.maximum.accumulate(raw - RATE * step_raw / np.sqrt(seen_raw) + np.arange(len(raw)) * 1e-6)
    return Model(weights, raw)


def _learner(shared: Broadcast, seed: int):
    """What a task does with one group: its changes to the weights, and its thresholds."""

    def learn(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("grade", "ascending")]).combine_chunks()
        column = rows["features"].chunk(0)
        flat, offsets = column.flatten().to_numpy(), column.offsets.to_numpy()
        lists = [flat[a - offsets[0] : b - offsets[0]] for a, b in zip(offsets[:-1], offsets[1:])]
        own = _learn(shared.value, rows["grade"].to_numpy(), lists, seed)
        change = own.weights - shared.value.weights
        moved = np.flatnonzero(change)
        columns = [[moved.tolist()], [change[moved].astype(float).tolist()], [own.thresholds.tolist()]]
        kinds = [("at", pa.list_(pa.int64())), ("change", pa.list_(pa.float64())), ("thresholds", pa.list_(pa.float64()))]
        return pa.table(columns, schema=pa.schema(kinds))

    return learn


def fit(sample: DataFrame) -> Model:
    """The model of a stored sample."""
    session = sample.sparkSession
    model = Model(np.zeros(1 << BITS, np.float32), np.arange(GRADES - 1, dtype=np.float64) - (GRADES - 2) / 2)
    # Groups of LABELLED / PARTS rows or so.
    parts = sample.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(PARTS))).groupBy("part")
    for r in range(ROUNDS):
        shared = session.sparkContext.broadcast(model)
        got = parts.applyInArrow(_learner(shared, r), "at array<long>, change array<double>, thresholds array<double>").collect()
        if not got:
            break
        weights = model.weights.astype(np.float64)
        for x in got:
            weights[np.array(x["at"], np.int64)] += np.array(x["change"]) / len(got)
        model = Model(weights.astype(np.float32), np.mean([x["thresholds"] for x in got], axis=0))
        shared.unpersist()
    return model


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `expected_grade`, `top_probability` and `kept`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = {"expected_grade": T.DoubleType(), "top_probability": T.DoubleType(), "kept": T.BooleanType()}
    rows = docs.drop(*own)
    schema = T.StructType([*rows.schema, *[T.StructField(n, t) for n, t in own.items()]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text):
            owner, feature = features(batch[text])
            score = np.bincount(owner, shared.value.weights[feature], batch.num_rows)
            grade, top = shared.value.judge(score)
            new = [pa.array(np.round(grade, 6)), pa.array(np.round(top, 6)), pa.array(top >= MIN_TOP)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema.names)

    return rows.mapInArrow(scan, schema)


def op4_grading(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(examples(docs, graded(table(spark, sf_dir, "labels"))))
    return scored(docs, model).drop("text")
