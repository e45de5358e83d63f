"""Token shards in training order.

1. Every text becomes token ids and an end mark, in one pass; the tokens are stored with
   their place in the task's stream. A task's total, one number, tells where the next
   task's stream starts.
2. The stream is cut into sequences of a fixed length. A keyed Feistel permutation with
   cycle-walking gives each sequence number its slot in the training order.
3. Slots are dealt to shards by range. A task sends the pieces for one shard together,
   compressed; the shard is put together at its place and written as records of one
   length: slot s is at byte (s - first slot of its shard) * stride.

The order of the stream is that of the input's files and rows. With the same files and
settings it is the same again, also for a task that is run a second time.

Reading from slot s on needs no index: `read_slots` opens the shards from s // shard slots on.
Spark's text sink writes a shard as one row of raw bytes, so it has one line end after its
last record; a reader takes whole records and stops there.

Memory: one batch of texts, or one shard, in a task. Skew: a source or a long text has no
part in how sequences are dealt.

Defined cases: a NULL or empty text gives only its end mark; repeated rows are tokenised as
they come; the last sequence is filled with end marks, which `n_tokens` leaves out; an
empty table gives no shard and no row.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import ceil_div, discard, keep, scratch_path, sliced, table
from lodeworks.llm.permute import feistel

SEQUENCE_TOKENS = 1024
SHARD_SLOTS = 2048
KEY = 20_260_101
# The vocabulary file is broadcast; a larger one is refused.
MAX_VOCABULARY_BYTES = 64 << 20

_ENCODERS: dict[str, object] = {}


@dataclass(frozen=True)
class Vocabulary:
    """A ranked byte-pair vocabulary file, base64 token and rank on each line."""

    ranks: bytes
    pattern: str

    @staticmethod
    def load(path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as file:
            ranks = file.read(MAX_VOCABULARY_BYTES + 1)
        if len(ranks) > MAX_VOCABULARY_BYTES:
            raise ValueError(f"{path} has more than {MAX_VOCABULARY_BYTES} bytes")
        return Vocabulary(ranks, pattern)

    @property
    def end(self) -> int:
        """The end mark: the id after the last."""
        return self.ranks.count(b"\n") + (not self.ranks.endswith(b"\n"))

    def encoder(self):
        """The tokeniser, made once in a process."""
        name = hashlib.sha256(self.ranks + self.pattern.encode()).hexdigest()
        if name not in _ENCODERS:
            import tiktoken

            pairs = (line.split() for line in self.ranks.splitlines() if line)
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
            _ENCODERS[name] = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return _ENCODERS[name]


@dataclass(frozen=True)
class Shards:
    """What was written: `path/shard=N/...`, and the numbers a reader needs."""

    path: str
    sequences: int
    tokens: int
    sequence_tokens: int
    shard_slots: int
    dtype: str
    key: int

    @property
    def stride(self) -> int:
        return self.sequence_tokens * np.dtype(self.dtype).itemsize


def tokenised(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, part, at, n, tokens`: a text's tokens, and where they are in its task's stream."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    dtype = np.uint16 if vocabulary.end < 1 << 16 else np.uint32

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, at = shared.value.encoder(), shared.value.end, 0
        part = TaskContext.get().partitionId()
        for batch in sliced(batches, "text", 1 << 22):
            ids = [[*encoder.encode_ordinary(t or ""), end] for t in batch["text"].to_pylist()]
            counts = np.array([len(x) for x in ids], np.int64)
            starts = at + np.cumsum(counts) - counts
            at += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(np.full(len(ids), part, np.int32)),
                    pa.array(starts),
                    pa.array(counts),
                    pa.array([np.array(x, dtype).tobytes() for x in ids], pa.binary()),
                ],
                ["doc_id", "part", "at", "n", "tokens"],
            )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(scan, "doc_id long, part int, at long, n long, tokens binary")


def _pieces(stream: DataFrame, base: dict[int, int], n: int, shards: Shards) -> DataFrame:
    """`shard, slots, offsets, counts, tokens`: for each batch, its part of each shard."""
    length, slots, key, dtype = shards.sequence_tokens, shards.shard_slots, shards.key, np.dtype(shards.dtype)
    shared = stream.sparkSession.sparkContext.broadcast(base)

    def cut(batch: pa.RecordBatch) -> Iterator[tuple]:
        """Sequence, first token in it, tokens: neighbours in the stream are joined first."""
        starts = batch["at"].to_numpy() + np.array([shared.value[p] for p in batch["part"].to_pylist()], np.int64)
        ends = starts + batch["n"].to_numpy()
        breaks = np.flatnonzero(np.concatenate([[True], starts[1:] != ends[:-1]]))
        blobs = batch["tokens"]
        for a, b in zip(breaks, [*breaks[1:], len(starts)]):
            tokens = np.frombuffer(b"".join(x.as_buffer() for x in blobs.slice(a, b - a)), dtype)
            first, last = int(starts[a]), int(ends[b - 1])
            for sequence in range(first // length, ceil_div(last, length)):
                low, high = max(first, sequence * length), min(last, (sequence + 1) * length)
                yield sequence, low - sequence * length, tokens[low - first : high - first]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard  # where shards are written and read only

        pack = zstandard.ZstdCompressor(3)
        for batch in sliced(batches, "tokens", 1 << 24):
            found = list(cut(batch))
            slot = feistel(np.array([s for s, _, _ in found], np.int64), n, key)
            order = np.argsort(slot, kind="stable")
            shard = slot[order] // slots
            groups = np.split(order, np.flatnonzero(np.diff(shard)) + 1) if len(order) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(slot[g[0]]) // slots for g in groups], pa.int64()),
                    pa.array([(slot[g] % slots).tolist() for g in groups], pa.list_(pa.int32())),
                    pa.array([[found[i][1] for i in g] for g in groups], pa.list_(pa.int32())),
                    pa.array([[len(found[i][2]) for i in g] for g in groups], pa.list_(pa.int32())),
                    pa.array([pack.compress(np.concatenate([found[i][2] for i in g]).tobytes()) for g in groups], pa.binary()),
                ],
                ["shard", "slots", "offsets", "counts", "tokens"],
            )

    return stream.select("part", "at", "n", "tokens").mapInArrow(
        scan, "shard long, slots array<int>, offsets array<int>, counts array<int>, tokens binary"
    )


def _assembled(pieces: DataFrame, n: int, shards: Shards, fill: int) -> DataFrame:
    """`shard, record`: all bytes of a shard; the pieces of a shard come together, one shard after another."""
    length, slots, dtype = shards.sequence_tokens, shards.shard_slots, np.dtype(shards.dtype)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard  # where shards are written and read only

        unpack = zstandard.ZstdDecompressor()
        current, buffer = -1, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([buffer.tobytes()], pa.binary())], ["shard", "record"])

        for batch in batches:
            for shard, at, offsets, counts, tokens in zip(*(batch[i].to_pylist() for i in range(5))):
                if shard != current:
                    if buffer is not None:
                        yield done()
                    current = shard
                    buffer = np.full((min(slots, n - shard * slots), length), fill, dtype)
                flat, start = np.frombuffer(unpack.decompress(tokens), dtype), 0
                for row, offset, count in zip(at, offsets, counts):
                    buffer[row, offset : offset + count] = flat[start : start + count]
                    start += count
        if buffer is not None:
            yield done()

    return pieces.mapInArrow(scan, "shard long, record binary")


def write_shards(
    docs: DataFrame,
    vocabulary: Vocabulary,
    path: str,
    sequence_tokens: int = SEQUENCE_TOKENS,
    shard_slots: int = SHARD_SLOTS,
    key: int = KEY,
) -> tuple[Shards, DataFrame]:
    """Write the shards; also `doc_id, at, n`: where each document's tokens are in the whole stream."""
    spark = docs.sparkSession
    dtype = "<u2" if vocabulary.end < 1 << 16 else "<u4"
    stored = scratch_path(spark, "tokens")
    tokenised(docs, vocabulary).write.option("compression", "zstd").parquet(stored)
    stream = spark.read.parquet(stored)
    # One number for each task of the first pass.
    totals = stream.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("n")).orderBy("part").collect()
    base, tokens = {}, 0
    for row in totals:
        base[row["part"]] = tokens
        tokens += row["n"]
    n = ceil_div(tokens, sequence_tokens)
    shards = Shards(path, n, tokens, sequence_tokens, shard_slots, dtype, key)
    if n:
        parts = min(ceil_div(n, shard_slots), 1 << 15)
        dealt = _pieces(stream, base, n, shards).repartitionByRange(parts, "shard").sortWithinPartitions("shard")
        whole = _assembled(dealt, n, shards, vocabulary.end)
        whole.select(F.col("record").cast("string"), "shard").write.partitionBy("shard").option("lineSep", "\n").text(path)
    bases = spark.createDataFrame(list(base.items()), "part int, base long")
    spans = stream.join(F.broadcast(bases), "part").select("doc_id", (F.col("at") + F.col("base")).alias("at"), "n")
    spans = keep(spans, "token-spans")
    discard(spark, stored)
    return shards, spans


def read_slots(spark: SparkSession, shards: Shards, start: int = 0) -> DataFrame:
    """`slot, shard, tokens` from slot `start` on; earlier shards are not opened."""
    stride, slots = shards.stride, shards.shard_slots

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch["shard"].to_pylist(), batch["content"]):
                content = content.as_buffer()
                places = [i for i in range(len(content) // stride) if shard * slots + i >= start]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard * slots + i for i in places], pa.int64()),
                        pa.array([shard] * len(places), pa.int64()),
                        pa.array([content.slice(i * stride, stride).to_pybytes() for i in places], pa.binary()),
                    ],
                    ["slot", "shard", "tokens"],
                )

    files = spark.read.format("binaryFile").load(shards.path).select(F.col("shard").cast("bigint").alias("shard"), "content")
    return files.where(F.col("shard") >= start // slots).mapInArrow(scan, "slot long, shard long, tokens binary")


def manifest(spark: SparkSession, shards: Shards, spans: DataFrame) -> DataFrame:
    """A row for each slot, from the shards as they were written: the documents in it and its digest."""
    columns = "slot bigint, shard bigint, byte_offset bigint, sequence bigint, n_tokens bigint, doc_ids array<bigint>, tokens_sha256 string"
    if not shards.sequences:
        return spark.createDataFrame([], columns)
    n, length, key, tokens = shards.sequences, shards.sequence_tokens, shards.key, shards.tokens

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = pa.array(feistel(batch["sequence"].to_numpy(), n, key))
            yield pa.RecordBatch.from_arrays([slot, *batch.columns], ["slot", *batch.schema.names])

    inside = spans.select(
        "doc_id",
        "at",
        F.explode(F.sequence(F.floor(F.col("at") / length), F.floor((F.col("at") + F.col("n") - 1) / length))).alias("sequence"),
    )
    # At most one document begins at each token of a sequence.
    docs = inside.groupBy("sequence").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "doc_id"))), lambda x: x["doc_id"]).alias("doc_ids"))
    docs = docs.mapInArrow(placed, "slot long, sequence long, doc_ids array<long>")
    read = read_slots(spark, shards).select("slot", "shard", F.sha2("tokens", 256).alias("tokens_sha256"))
    return read.join(docs.hint("merge"), "slot").select(
        "slot",
        "shard",
        ((F.col("slot") - F.col("shard") * shards.shard_slots) * shards.stride).alias("byte_offset"),
        "sequence",
        F.least(F.lit(length), F.lit(tokens) - F.col("sequence") * length).cast("bigint").alias("n_tokens"),
        "doc_ids",
        "tokens_sha256",
    )


def public_vocabulary() -> Vocabulary:
    """The byte-level vocabulary that the registered query uses."""
    import public_tokenizers

    return Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shards, spans = write_shards(docs, public_vocabulary(), scratch_path(spark, "shards"))
    return manifest(spark, shards, spans)
