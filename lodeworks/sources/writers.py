"""Writers for the reports made from operator results.

The `*_lines` functions build the text as a DataFrame; the `write_*` functions
store it. Lists inside a line are bounded by the n of the report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(rows: DataFrame, path: str) -> None:
    rows.select("value").write.mode("overwrite").text(path)


def friend_lists(recommended: DataFrame) -> DataFrame:
    """`user, candidates, n_mutual`: one row per user, both lists in rank order.

    A user without candidates gets two empty strings.
    """
    ranked = F.sort_array(
        F.collect_list(F.when(F.col("candidate").isNotNull(), F.struct("rank", "candidate", "n_mutual")))
    )
    lists = recommended.groupBy("user").agg(ranked.alias("best"))
    return lists.select(
        "user",
        F.concat_ws(",", F.col("best.candidate").cast("array<string>")).alias("candidates"),
        F.concat_ws(",", F.col("best.n_mutual").cast("array<string>")).alias("n_mutual"),
    )


def friend_lines(recommended: DataFrame) -> DataFrame:
    """`value`, by ascending user: `user <tab> a,b,c`, or the user alone."""
    lists = friend_lists(recommended).orderBy("user")
    name = F.col("user").cast("string")
    return lists.select(
        F.when(F.col("candidates") == "", name)
        .otherwise(F.concat(name, F.lit(" \t "), F.col("candidates")))
        .alias("value")
    )


def write_friends(recommended: DataFrame, path: str) -> None:
    _text(friend_lines(recommended), path)


def rule_lines(rules: DataFrame) -> DataFrame:
    """`value`, best rule first: `Conf: c <tab> Rule: x => y` or `(x, y) => z`."""
    conf: Column = F.format_string("%.8f", "confidence")
    if "z" in rules.columns:
        rule = F.format_string("(%s, %s) => %s", "x", "y", "z")
        order = ["x", "y", "z"]
    else:
        rule = F.format_string("%s => %s", "x", "y")
        order = ["x", "y"]
    return rules.orderBy(F.desc("confidence"), *order).select(
        F.concat(F.lit("Conf: "), conf, F.lit("\tRule: "), rule).alias("value")
    )


def write_rules(rules: DataFrame, path: str) -> None:
    _text(rule_lines(rules), path)


def score_lines(top: DataFrame, titles: DataFrame) -> DataFrame:
    """`value`, by user and rank: the score with five digits and the title."""
    return (
        top.join(titles, "item")
        .orderBy("user", "rank")
        .select(
            F.concat(
                F.lit("\tSimilarity score = "), F.format_string("%.5f", "score"), F.lit(" \tMovie:  "), F.col("title")
            ).alias("value")
        )
    )


def write_scores(top: DataFrame, titles: DataFrame, path: str) -> None:
    _text(score_lines(top, titles), path)


def cost_lines(drops: DataFrame) -> DataFrame:
    """`value` per metric and init: the share of the first cost that is left, and its drop."""
    return drops.orderBy("metric", "init").select(
        F.format_string(
            "%s %s: Cost changed to: %.2f%%\tDropped: %.2f%%", "metric", "init", "pct_of_first", "pct_dropped"
        ).alias("value")
    )


def write_trace(trace: DataFrame, path: str) -> None:
    """A cost or objective trace as CSV with a header, in order."""
    keys = [c for c in ("metric", "init", "lr", "iteration", "epoch") if c in trace.columns]
    trace.orderBy(*keys).write.mode("overwrite").option("header", True).csv(path)


def write_parquet(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)
