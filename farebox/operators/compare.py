"""Appending and comparing frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Append by column name (``UNION ALL``; no shuffle)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def schema_signature(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def frame_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either side missing from the other, with multiplicity, tagged with the side.

    One shuffle instead of two ``exceptAll`` passes: both sides are tagged
    +1 / -1, grouped on all columns (partial aggregation first, so identical
    rows collapse map-side), groups that do not cancel are kept and expanded
    back to one row per surplus copy.  Grouping treats nulls as equal and
    normalises NaN and -0.0, like ``exceptAll``.  Empty when both frames hold
    the same multiset of rows; schemas must match (names, types, order).
    """
    if schema_signature(left) != schema_signature(right):
        raise ValueError(f"schemas differ: {schema_signature(left)} vs {schema_signature(right)}")
    cols = left.columns
    tagged = left.withColumn("_w", F.lit(1)).unionByName(right.withColumn("_w", F.lit(-1)))
    net = tagged.groupBy(*cols).agg(F.sum("_w").alias("_n")).where(F.col("_n") != 0)
    return net.select(
        *cols,
        F.when(F.col("_n") > 0, F.lit("left_only")).otherwise(F.lit("right_only")).alias("side"),
        F.explode(F.sequence(F.lit(1), F.abs(F.col("_n")))).alias("_copy"),
    ).drop("_copy")


def frames_equal(left: DataFrame, right: DataFrame) -> bool:
    """True when schemas and row multisets are equal (one job, stops at the first difference)."""
    if schema_signature(left) != schema_signature(right):
        return False
    return frame_difference(left, right).isEmpty()
