"""Token counts by an exact length histogram (operator 5).

Documents are counted by encoded length (combined before the shuffle).  Prefix
and suffix sums over the histogram run in two levels, within ranges of
``RANGE`` lengths and over the ranges, so no task orders more than one
range or the list of ranges.  A row of the result answers one context limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farebox.llm.bpe import token_counts
from farebox.llm.common import materialize

RANGE = 1024


def length_histogram(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(n_tokens, n_docs): documents of each encoded length."""
    counts = token_counts(docs, path, pattern).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    return materialize(counts, "length_histogram")  # both levels of sums read it


def limits(histogram: DataFrame) -> DataFrame:
    """One row per length that occurs, read as a context limit.

    docs_within / tokens_within: documents of at most the limit and their tokens;
    docs_over / tokens_over: the longer ones; tokens_kept: the total when every
    document is cut to the limit; tokens_cut: what that loses; quantile: share of
    documents within.  An empty histogram gives no rows.
    """
    h = histogram.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
                         F.floor(F.col("n_tokens") / RANGE).alias("part"))
    ranges = h.groupBy("part").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    below = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    above = W.orderBy("part").rowsBetween(1, W.unboundedFollowing)
    zero = F.lit(0).cast("long")
    ranges = ranges.select("part", *[F.coalesce(F.sum(c).over(w), zero).alias(f"{c}_{n}")
                                     for c in "dt" for n, w in (("below", below), ("above", above))])
    within = W.partitionBy("part").orderBy("n_tokens").rowsBetween(W.unboundedPreceding, 0)
    over = W.partitionBy("part").orderBy("n_tokens").rowsBetween(1, W.unboundedFollowing)
    sums = h.select("part", "n_tokens", "n_docs",
                    *[F.coalesce(F.sum(c).over(w), zero).alias(f"{c}_{n}")
                      for c in ("n_docs", "tokens") for n, w in (("within", within), ("over", over))])
    out = sums.join(ranges, "part").select(
        F.col("n_tokens").alias("context_limit"), "n_docs",
        (F.col("n_docs_within") + F.col("d_below")).alias("docs_within"),
        (F.col("tokens_within") + F.col("t_below")).alias("tokens_within"),
        (F.col("n_docs_over") + F.col("d_above")).alias("docs_over"),
        (F.col("tokens_over") + F.col("t_above")).alias("tokens_over"))
    kept = F.col("tokens_within") + F.col("context_limit") * F.col("docs_over")
    return (out.withColumn("tokens_kept", kept)
            .withColumn("tokens_cut", F.col("tokens_within") + F.col("tokens_over") - kept)
            .withColumn("quantile", F.col("docs_within") / (F.col("docs_within") + F.col("docs_over"))))


def truncated_total(answers: DataFrame, limit: int) -> DataFrame:
    """(tokens_kept): tokens left when documents are cut to any ``limit`` (one row; null for an empty table)."""
    low = F.max(F.when(F.col("context_limit") <= limit, F.struct("context_limit", "tokens_within", "docs_over")))
    total = F.max(F.col("docs_within") + F.col("docs_over"))
    return answers.agg(low.alias("low"), total.alias("docs")).select(
        F.coalesce(F.col("low.tokens_within") + limit * F.col("low.docs_over"), limit * F.col("docs")).alias("tokens_kept"))


def length_quantile(answers: DataFrame, q: float) -> DataFrame:
    """(n_tokens): least length that at least a share ``q`` of the documents do not exceed."""
    return answers.where(F.col("quantile") >= q).agg(F.min("context_limit").alias("n_tokens"))


def token_lengths(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """:func:`limits` of the documents' histogram.

    Null and empty texts have length 0; repeated rows count each; doc_id and
    other columns are ignored; an empty table gives no rows.
    """
    return limits(length_histogram(docs, path, pattern))
