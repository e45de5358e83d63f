"""Quality rules with a verdict on each host.

A document fails by itself if it is too short or repeats itself. Failures are
added up by host, here the document's source; each host's failure rate is
shrunk towards the corpus by a beta prior whose two parameters are fitted to the
hosts' rates by moments; a host that still fails too often loses all documents.

Built-in expressions only. Everything about one text is computed within its row,
so texts are never shuffled; what is shuffled is one partial sum per host and task.

Defined cases: a NULL or empty text has no words and fails; NULL hosts form one
host of their own; repeated rows are judged one by one; an empty table gives an
empty table. Columns of the input are kept, except those named like a new one,
which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.common import keep, let, small, table

# Fixed values of the rules.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# A host is refused when more than this share of its documents fails, after shrinking.
MAX_HOST_RATE = 0.5

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeated_words(words: Column) -> Column:
    """Words inside a three-word window that the list holds twice or more.

    Each window becomes one number: its hash in the high bits, its place in the
    low ones. Sorted, equal windows stand side by side; the words themselves are
    compared where the high bits agree.
    """

    def same(words: Column, p: Column, q: Column) -> Column:
        at = [F.get(words, p + k) == F.get(words, q + k) for k in range(3)]
        return at[0] & at[1] & at[2]

    def covered(starts: Column) -> Column:
        words = F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))
        return F.size(F.array_distinct(words)).cast("bigint")

    def by_width(words: Column, width: Column) -> Column:
        place = F.call_function("shiftleft", F.lit(1).cast("bigint"), width) - 1

        def key(i: Column) -> Column:
            window = F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
            return F.call_function("shiftleft", window, width).bitwiseOR(i.cast("bigint"))

        def starts(keys: Column) -> Column:
            def equal(k: Column, other: Column) -> Column:
                high = F.call_function("shiftright", k, width) == F.call_function("shiftright", other, width)
                p, q = k.bitwiseAND(place).cast("int"), other.bitwiseAND(place).cast("int")
                return high & same(words, p, q)

            def held(k: Column, i: Column) -> Column:
                return equal(k, F.get(keys, i - 1)) | equal(k, F.get(keys, i + 1))

            return F.transform(F.filter(keys, held), lambda k: k.bitwiseAND(place))

        keys = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), key))
        return let(let(keys, starts), covered)

    found = let(F.length(F.bin(F.size(words).cast("bigint"))), lambda width: by_width(words, width))
    return F.when(F.size(words) >= 3, found).otherwise(F.lit(0).cast("bigint"))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the five counts and `base_failed`."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("bigint").alias("n"), _repeated_words(words).alias("r"))

    counts = let(F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)), of_words)
    seen = docs.withColumn("_counts", counts)
    seen = seen.withColumns(
        {
            "n_words": F.col("_counts.n"),
            "word_chars": F.length(F.translate(whole, BLANKS, "")).cast("bigint"),
            "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("bigint"),
            "n_dup_lines": dup_lines.cast("bigint"),
            "n_repeat_words": F.col("_counts.r"),
        }
    ).drop("_counts")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return seen.withColumn("base_failed", failed)


def host_verdicts(judged: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """`host, host_docs, host_failed, host_rejected`: one row per host."""
    sums = judged.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("host_docs"), F.count_if(F.col("base_failed")).alias("host_failed")
    )
    rate = F.col("host_failed") / F.col("host_docs")
    # One row: mean and variance of the hosts' rates.
    spread = sums.agg(F.avg(rate).alias("_mean"), F.var_samp(rate).alias("_var"))
    weight = F.col("_mean") * (1 - F.col("_mean")) / F.col("_var") - 1
    # Rates that do not differ pull every host to the mean; rates of 0 and 1 only leave them alone.
    weight = F.when(F.coalesce(F.col("_var"), F.lit(0.0)) <= 0, 1e6).otherwise(F.least(F.greatest(weight, F.lit(1.0)), F.lit(1e6)))
    prior = spread.select("_mean", weight.alias("_weight"))
    shrunk = (F.col("host_failed") + F.col("_weight") * F.col("_mean")) / (F.col("host_docs") + F.col("_weight"))
    return (
        sums.withColumn("_one", F.lit(1))
        .join(F.broadcast(prior.withColumn("_one", F.lit(1))), "_one")
        .select("_host", "host_docs", "host_failed", (shrunk > max_rate).alias("host_rejected"))
    )


def judge(
    judged: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE, verdicts: DataFrame | None = None
) -> DataFrame:
    """What `measured` gives, with host verdicts joined back, and `kept`.

    Without `verdicts`, `judged` is read twice, so pass a stored table.
    """
    verdicts = small(host_verdicts(judged, host, max_rate) if verdicts is None else verdicts)
    joined = judged.drop("host_docs", "host_failed", "host_rejected")
    joined = joined.join(verdicts, joined[host].eqNullSafe(verdicts["_host"]), "left").drop("_host")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    judged = keep(measured(docs).drop("text"), "host-rules")
    return judge(judged).select(
        "doc_id", *MEASURES, "base_failed", "kept", "host_docs", "host_failed", "host_rejected"
    )


OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), ws AS (
  SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d
), w AS (
  SELECT rid, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM ws
), t AS (
  SELECT rid, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS g
  FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)
), r AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM t WHERE g IS NOT NULL) WHERE n > 1
), c AS (
  SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, i + k AS p FROM r, (VALUES (0), (1), (2)) AS v(k)) GROUP BY rid
), l AS (
  SELECT rid, count(*) - count(DISTINCT l) AS n
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid
), m AS (
  SELECT d.rid, doc_id, source, len(ws) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(l.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM d JOIN ws USING (rid) LEFT JOIN l USING (rid) LEFT JOIN c USING (rid)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), h AS (
  SELECT source, count(*) AS host_docs, count(*) FILTER (base_failed) AS host_failed FROM b GROUP BY source
), v AS (
  SELECT avg(host_failed / host_docs) AS mean, var_samp(host_failed / host_docs) AS var FROM h
), p AS (
  SELECT mean, CASE WHEN coalesce(var, 0) <= 0 THEN 1e6
    ELSE least(greatest(mean * (1 - mean) / var - 1, 1.0), 1e6) END AS weight FROM v
), j AS (
  SELECT h.*, (host_failed + weight * mean) / (host_docs + weight) > 0.5 AS host_rejected FROM h, p
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT host_rejected AS kept, host_docs, host_failed, host_rejected
FROM b JOIN j ON b.source IS NOT DISTINCT FROM j.source
"""
