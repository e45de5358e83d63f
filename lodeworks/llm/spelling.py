"""Spelling variants: words one letter apart, and the common word that each stands for.

1. Words are counted over all texts with built-in expressions, summed before they are shuffled.
2. Two words one letter apart, the shorter of s letters, are alike in their first or in their last half.
   So words are grouped by s, and a group of more than BLOCK words is dealt into two kinds of
   smaller ones, by the letters of either half of what is still free; and so again, until every group
   is small. The last groups are free in one letter, which bounds them by the alphabet. No
   pair is lost, and no group is capped.
3. In a group, each (position, letter) is a bitset over its words. A word of s letters runs
   through all others at once: at every letter three bitsets go on, the words without an error so far, those
   with one letter replaced, and those with one inserted, whose positions are shifted by one.
   What is left at the end is near. Deletions are insertions seen from the longer word.
4. Near words are counted, each word gets its form, and roots are found by following forms, each round
   doubling the way; a form has at least twice the count, so ways are short and without circles.

Memory in a task: one group, BLOCK bits for each (position, letter). Pairs made: the near ones, twice at
most for every halving.

Defined cases: NULL and empty texts have no words; a NULL doc_id counts as empty in the hash; repeated rows
count each time; ties between forms go to the first in code-point order; an empty table gives an
empty table; other columns are not read; words of any length are handled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import keep, small, table

MIN_LETTERS = 5
MIN_COUNT = 3
# One occurrence in so many loses a letter.
ERROR_EVERY = 97
BLOCK = 1024
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int | None = ERROR_EVERY) -> DataFrame:
    """`word`, a row for each run of letters; one in `every`, by its hash, has lost a letter."""
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("_run"),
    ).select("_id", F.translate("_run", UPPER, LOWER).alias("word"))
    if every is None:
        return runs.select("word")
    h = F.crc32(F.concat("_id", F.lit(":"), "word").cast("binary"))
    at = (h % F.char_length("word")).cast("int")
    less = F.concat(F.expr("left(word, _at)"), F.expr("right(word, char_length(word) - _at - 1)"))
    return runs.withColumn("_h", h).withColumn("_at", at).select(
        F.when(F.col("_h") % every == 0, less).otherwise(F.col("word")).alias("word")
    )


def vocabulary(words: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """`word, n` of the words that are long and frequent enough."""
    counted = words.where(F.char_length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _key(head: Column, tail: Column) -> list[Column]:
    """The letters that a group's words have in common, by how many at either end."""
    return [
        head.cast("int").alias("head"),
        tail.cast("int").alias("tail"),
        F.expr("left(word, head)").alias("first"),
        F.expr("right(word, tail)").alias("last"),
    ]


GROUP = ["s", "head", "tail", "first", "last"]


def groups(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """`s, head, tail, words`: groups of words of s or s + 1 letters, in one of which every near pair meets."""
    length = F.char_length("word")
    placed = words.select("word", F.explode(F.array(length, length - 1)).alias("s"))
    placed = placed.withColumns({"head": F.lit(0), "tail": F.lit(0), "first": F.lit(""), "last": F.lit("")})
    ready: DataFrame | None = None
    while True:
        free = F.col("s") - F.col("head") - F.col("tail")
        placed = keep(placed, "placed")
        sizes = placed.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("_n"), F.min(F.char_length("word")).alias("_least"))
        # A group needs a word of s letters and another one.
        sizes = keep(sizes.where((F.col("_n") > 1) & (F.col("_least") == F.col("s"))), "group-sizes")
        split = (F.col("_n") > block) & (free > 1)
        done = placed.join(small(sizes.where(~split).select(*GROUP)), GROUP)
        ready = done if ready is None else ready.unionByName(done)
        larger = sizes.where(split).select(*GROUP)
        if larger.isEmpty():
            break
        half = F.floor(free / 2)
        halves = F.array(
            F.struct((F.col("head") + half).alias("head"), F.col("tail").cast("long").alias("tail")),
            F.struct(F.col("head").cast("long").alias("head"), (F.col("tail") + free - half).alias("tail")),
        )
        placed = (
            placed.join(small(larger), GROUP)
            .select("word", "s", F.explode(halves).alias("_half"))
            .select("word", "s", "_half.*")
            .select("word", "s", *_key(F.col("head"), F.col("tail")))
        )
    return ready.groupBy(*GROUP).agg(F.collect_list("word").alias("words")).select("s", "head", "tail", "words")


def near_pairs(words: list[str], s: int, head: int, tail: int) -> list[tuple[str, str]]:
    """The pairs one letter apart whose shorter word has s letters; all share `head` first and `tail` last letters."""
    middles = [w[head : len(w) - tail] for w in words]
    free = s - head - tail
    index: list[dict[str, int]] = [{} for _ in range(free + 2)]
    sizes = {free: 0, free + 1: 0}
    for at, middle in enumerate(middles):
        bit = 1 << at
        sizes[len(middle)] |= bit
        for place, letter in enumerate(middle):
            index[place][letter] = index[place].get(letter, 0) | bit
    everyone, equal, longer = (1 << len(words)) - 1, sizes[free], sizes[free + 1]
    found = []
    for at, middle in enumerate(middles):
        if len(middle) != free:
            continue
        right, replaced, inserted = everyone, 0, 0
        for place, letter in enumerate(middle):
            same = index[place].get(letter, 0)
            inserted = (inserted | right) & index[place + 1].get(letter, 0)
            replaced = replaced & same | right & ~same
            right &= same
        near = (replaced & equal) >> (at + 1) << (at + 1) | (inserted | right) & longer
        while near:
            low = near & -near
            found.append((words[at], words[low.bit_length() - 1]))
            near ^= low
    return found


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """`a, b`: every pair of words one letter apart, both ways round, once each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, head, tail = (batch[c].to_pylist() for c in ("s", "head", "tail"))
            for at, listed in enumerate(batch["words"]):
                pairs = near_pairs(listed.as_py(), s[at], head[at], tail[at])
                if pairs:
                    a, b = zip(*pairs)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    pairs = keep(groups(words, block).mapInArrow(scan, "a string, b string").distinct(), "near-pairs")
    return pairs.union(pairs.select("b", "a"))


def roots(forms: DataFrame) -> DataFrame:
    """`word, root` of the words that have a form: the last form on the way."""
    ways = keep(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        ahead = ways.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        longer = ways.join(ahead, F.col("root") == F.col("_at"), "left")
        ways = keep(longer.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_went")), "ways")
        if ways.where("_went").isEmpty():
            return ways.select("word", "root")
        ways = ways.drop("_went")


def variants(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """`word, form, root, n, n_near, form_n` for a vocabulary `word, n`."""
    words = keep(words, "vocabulary")
    counts = words.select(F.col("word").alias("b"), F.col("n").alias("_of"))
    best = (
        near_words(words.select("word"), block)
        .join(counts, "b")
        .groupBy(F.col("a").alias("word"))
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("_of")).alias("less"), F.col("b").alias("form"))).alias("_best"))
    )
    rows = words.join(best, "word", "left")
    has = -F.col("_best.less") >= 2 * F.col("n")
    rows = keep(
        rows.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("_best.form")).alias("form"), F.when(has, -F.col("_best.less")).alias("form_n"),
        ),
        "forms",
    )
    found = rows.join(roots(rows.where(F.col("form").isNotNull())), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(occurrences(table(spark, sf_dir, "documents"))))


# The letters beyond ASCII stand for others in `levenshtein`, which counts bytes.
OP13_SQL = r"""
WITH tab AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) r(i))
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
), each AS (
  SELECT id, run, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, length(run) AS len, xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(id || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END)),
    lambda c, b: xor(c // 256, tab[1 + (xor(c, b) % 256)]))) AS h FROM each, tab
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % len)::INTEGER) || substr(run, (h % len)::INTEGER + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), plain AS (
  SELECT word, n, length(word) AS len, translate(word, 'ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ',
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!"#$%&()*+,-./:;<=>?@[]^_{|}') AS p FROM words
), near AS (
  SELECT a.word, b.word AS other, b.n AS of FROM plain a JOIN plain b
  ON b.len BETWEEN a.len - 1 AND a.len + 1 AND a.word <> b.word AND (a.p[1] = b.p[1] OR a.p[-2:] = b.p[-2:]) AND levenshtein(a.p, b.p) = 1
), best AS (
  SELECT word, count(*)::BIGINT AS n_near, max(of) AS form_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= 2 * w.n THEN b.form_n END AS form_n,
    (SELECT min(other) FROM near x WHERE x.word = w.word AND x.of = b.form_n AND b.form_n >= 2 * w.n) AS form
  FROM words w LEFT JOIN best b USING (word)
), ways AS (
  WITH RECURSIVE r AS (
    SELECT word, form AS ahead, 1 AS steps FROM forms WHERE form IS NOT NULL
    UNION ALL SELECT r.word, f.form, steps + 1 FROM r JOIN forms f ON f.word = r.ahead WHERE f.form IS NOT NULL
  ) SELECT word, arg_max(ahead, steps) AS root FROM r GROUP BY word
)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN ways USING (word)
"""
