"""Mixing sources to target weights.

The words of each source, its documents one after another, are packed into blocks
of a fixed length. The mix is a row of output slots, cut into shards. A source has
as many slots as its target asks for; one pseudorandom permutation of all slots
deals them to the shards, so that the counts of the sources in a shard are
multinomial draws given the totals. The k-th slot of a source takes the block at
place k of that source's own permutation, a new one for each round through its
blocks, and blocks are joined to slots by index.

A permutation is a Feistel network on pairs (x, y) with x < a, y < b, where a * b is
the number of places or a little more. Places beyond the blocks are empty, so
nothing has to be searched and the whole is one expression.

Targets: each source gets a share of 150 % of all words in proportion to its weight,
at most twice its own size; what it can't take is shared again. As a threshold: sources
in the order of 2 * size / weight are at the limit up to some source, and the rest share
the remainder. Window functions over one row per source find it.

Built-in expressions only. A hot source is split by hash for its running sums; block
and slot rows are keyed by (source, block), which no source makes hot.

Defined cases: a NULL or empty text has size 0 and gives no words; NULL is a source,
the last; identical rows count one by one and may differ in `taken`; an empty table gives
an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodeworks.llm.common import keep, parts_for, small, table

# Fixed values of the mix.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2

# Words of a block, blocks of an output shard.
BLOCK_WORDS = 32
SHARD_SLOTS = 65_536
SEED = 20_260_101
ROUNDS = 4

# Documents in one part of a source's running sum; slots made from one row.
PART_DOCS = 2_000
CHUNK_SLOTS = 1 << 14


def shuffled(place: Column, a: Column, b: Column, *keys: Column) -> Column:
    """The place that `place` < a * b goes to, by a permutation that `keys` choose."""
    x, y = F.pmod(place, a), F.floor(place / a)
    for r in range(0, ROUNDS, 2):
        x = F.pmod(x + F.pmod(F.xxhash64(y, F.lit(r), *keys), a), a)
        y = F.pmod(y + F.pmod(F.xxhash64(x, F.lit(r + 1), *keys), b), b)
    return y * a + x


def _sides(n: Column) -> tuple[Column, Column]:
    a = F.greatest(F.ceil(F.sqrt(n)), F.lit(1)).cast("bigint")
    return a, F.greatest(F.ceil(n / a), F.lit(1)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """From `source, source_size`: with `source_id`, `weight` and `target`.

    `sizes` has one row per source, and so do the windows without a partition.
    """
    place = F.row_number().over(W.orderBy(F.col("source").isNull(), "source"))
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    rows = sizes.withColumn("source_id", place).withColumn(
        "weight", F.get(weights, F.pmod(F.col("source_id") - 1, F.lit(len(WEIGHTS))))
    )
    most = MOST * F.col("source_size")
    order = W.orderBy(most / F.col("weight"), "source_id")
    up_to = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = rows.withColumns(
        {
            "_level": (
                SHARE * F.sum("source_size").over(everything) - (F.sum(most).over(up_to) - most)
            )
            / F.sum("weight").over(rest),
            "_most": most,
        }
    )
    # Below the limit every source gets the same level; it is that of the first such source.
    free = F.col("_most") > F.col("_level") * F.col("weight")
    level = F.min(F.when(free, F.struct(F.col("_most") / F.col("weight"), "source_id", "_level"))).over(everything)
    target = F.when(free, F.col("weight") * level["_level"]).otherwise(F.col("_most").cast("double"))
    return rows.select("source", "source_id", "source_size", "weight", target.alias("target"))


@dataclass(frozen=True)
class Mix:
    """docs: `_row, source_id, size, ...`; pieces: which words of a document a block holds;
    slots: the mix itself, `shard, slot, source_id, block`."""

    docs: DataFrame
    pieces: DataFrame
    slots: DataFrame


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `size`, its words, and `_row`, a number of its own; store it before use."""
    return docs.withColumns({"size": size_of(text), "_row": F.monotonically_increasing_id()})


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> Mix:
    """The mix of a stored table made by `sized` with `doc_id` and `source`."""
    docs = docs.drop("source_size", "source_id", "target")
    key = F.lit(seed)
    goals = targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")))
    a, b = _sides(F.ceil(F.col("source_size") / block_words))
    places = F.col("_a") * F.col("_b")
    # The share of its blocks that a source's target asks for, of the permuted places.
    n_slots = F.when(F.col("source_size") > 0, F.round(places * F.col("target") / F.col("source_size"))).otherwise(0)
    goals = goals.withColumns({"_a": a, "_b": b}).withColumn("_slots", n_slots.cast("bigint"))
    first = W.orderBy("source_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    goals = goals.withColumns(
        {"_first": F.sum("_slots").over(first) - F.col("_slots"), "_all": F.sum("_slots").over(everything)}
    )
    goals = keep(goals, "mix-sources")
    hinted = small(goals)

    named = docs.join(
        hinted.select(F.col("source").alias("_source"), "source_id", "source_size", "target"),
        docs["source"].eqNullSafe(F.col("_source")),
    ).drop("_source")

    # Where each document starts among its source's words: documents in the order of a hash,
    # summed within parts, the parts' sums added. The parts are ranges of the hash.
    parts = parts_for(docs.count(), PART_DOCS)
    width = parts.bit_length() - 1
    hashed = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    part = F.call_function("shiftright", hashed, F.lit(64 - width)) if width else F.lit(0).cast("bigint")
    light = named.where(F.col("size") > 0).select(
        "_row", "doc_id", "source_id", "size", hashed.alias("_hash"), part.alias("_part")
    )
    within = W.partitionBy("source_id", "_part").orderBy("_hash", "doc_id", "size", "_row")
    before = W.partitionBy("source_id").orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = light.groupBy("source_id", "_part").agg(F.sum("size").alias("_n"))
    totals = totals.select("source_id", "_part", (F.sum("_n").over(before) - F.col("_n")).alias("_start"))
    placed = (
        light.withColumn("_in", F.sum("size").over(within.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size"))
        .join(totals, ["source_id", "_part"])
        .select("_row", "source_id", "size", (F.col("_start") + F.col("_in")).alias("_at"))
    )
    end = F.col("_at") + F.col("size")
    block_start = F.col("block") * block_words
    pieces = placed.select(
        "*",
        F.explode(F.sequence(F.floor(F.col("_at") / block_words), F.floor((end - 1) / block_words))).alias("block"),
    ).select(
        "_row",
        "source_id",
        "block",
        (F.greatest(block_start, F.col("_at")) - F.col("_at")).alias("from_word"),
        (F.least(block_start + block_words, end) - F.greatest(block_start, F.col("_at"))).alias("n"),
    )

    # Slots: a row for each run of them, dealt to the tasks, then a row for each.
    runs = goals.where(F.col("_slots") > 0).select(
        "source_id", "_a", "_b", "_slots", "_first", "_all",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("_slots") - 1) / CHUNK_SLOTS))).alias("_run"),
    )
    session = docs.sparkSession
    usual = int(session.conf.get("spark.sql.shuffle.partitions"))
    last = F.least(F.col("_slots"), (F.col("_run") + 1) * CHUNK_SLOTS) - 1
    each = runs.repartition(usual).select(
        "source_id", "_a", "_b", "_first", "_all", F.explode(F.sequence(F.col("_run") * CHUNK_SLOTS, last)).alias("_k")
    )
    around = F.floor(F.col("_k") / (F.col("_a") * F.col("_b")))
    block = shuffled(F.pmod("_k", F.col("_a") * F.col("_b")), F.col("_a"), F.col("_b"), key, F.col("source_id"), around)
    slot = shuffled(F.col("_first") + F.col("_k"), *_sides(F.col("_all")), key)
    slots = each.select(slot.alias("slot"), "source_id", block.alias("block")).select(
        F.floor(F.col("slot") / SHARD_SLOTS).alias("shard"), "slot", "source_id", "block"
    )
    return Mix(named, pieces, slots)


def used(mixed: Mix) -> DataFrame:
    """The pieces of documents that the mix takes, with `times`, how often."""
    times = mixed.slots.groupBy("source_id", "block").agg(F.count(F.lit(1)).alias("times"))
    # Without a hint the planner takes a few source rows for the size of all slots and broadcasts them.
    return mixed.pieces.join(times.hint("merge"), ["source_id", "block"])


def taken(mixed: Mix) -> DataFrame:
    """Each document of the mix with `taken`, the number of its words in the mix."""
    words = used(mixed).groupBy("_row").agg(F.sum(F.col("n") * F.col("times")).alias("taken"))
    return mixed.docs.join(words, "_row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("bigint")))


def drawn(mixed: Mix, text: str = "text") -> DataFrame:
    """The documents as the mix takes them: one row for each time, with the words drawn that time.

    A word keeps the white space after it. `mixed.docs` must have the texts.
    """
    ranges = (
        used(mixed)
        .select("_row", "from_word", "n", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_time"))
        .groupBy("_row", "_time")
        .agg(F.sort_array(F.collect_list(F.struct("from_word", "n"))).alias("_ranges"))
    )
    words = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    with_words = mixed.docs.join(ranges, "_row").withColumn("_words", F.array(words))
    cut = F.transform(
        "_words",
        lambda w: F.array_join(
            F.transform(
                "_ranges",
                lambda r: F.array_join(F.slice(w, r["from_word"].cast("int") + 1, r["n"].cast("int")), ""),
            ),
            "",
        ),
    )
    return with_words.withColumn(text, F.rtrim(F.get(cut, F.lit(0)))).drop("_words", "_ranges", "_time")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    stored = keep(sized(docs).drop("text"), "mix-sizes")
    return taken(mix(stored)).select("doc_id", "size", "source_size", "target", "taken", "source")
