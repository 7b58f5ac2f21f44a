"""Global row positions (L2, S12, M2, P16): file order, first rows, and splits of exact sizes.

A position is stable: files in order of their paths, rows in order within them.
``read_positions`` takes it from file metadata (each row knows its file and its
number in it) and one count per file, without moving a row; ``dense_positions``
numbers the rows left after any filters by ranges of a key and one count per
range.  No task orders more than a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farebox.operators.aggregate import materialize
from farebox.operators.enrich import checked_broadcast

_PART_BITS = 33   # monotonically_increasing_id: partition above these bits, row below
# Ends of the training and validation shares; each boundary is cut to a whole row.
SPLIT_ENDS = {"train": 0.70, "validation": 0.85, "test": 1.0}


def read_positions(spark: SparkSession, path: str | list[str], columns: list[str] | None = None,
                   name: str = "position") -> DataFrame:
    """Parquet rows with their global position from 0 (files by path, then row order)."""
    paths = [path] if isinstance(path, str) else list(path)
    rows = spark.read.parquet(*paths)
    keep = [F.col(f"`{c}`") for c in (columns or rows.columns)]
    counts = rows.groupBy(F.col("_metadata.file_path").alias("__file")).agg(F.count("*").alias("n"))
    before = W.orderBy("__file").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    offsets = counts.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    offsets, _ = checked_broadcast(offsets, "__file")
    placed = rows.select(*keep, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    return placed.join(offsets, "__file").select(*keep, (F.col("__offset") + F.col("__row")).alias(name))


def dense_positions(df: DataFrame, order: str | list[str], name: str = "position") -> DataFrame:
    """``df`` numbered from 0 in the order of the column(s) ``order`` (of any type, nulls first; ties in any order).

    Rows are dealt out by ranges of ``order`` and written with their number in
    the range; the rows of earlier ranges come from a table of one row per range.
    """
    keys = [order] if isinstance(order, str) else list(order)
    placed = materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("__at", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("__at", _PART_BITS)
    ranges = placed.groupBy(part.alias("__part")).agg(F.min("__at").alias("__first"), F.count("*").alias("n"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select("__part", "__first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    ranges, _ = checked_broadcast(ranges, "__part")
    return (placed.withColumn("__part", part).join(ranges, "__part")
            .select(*df.columns, (F.col("__at") - F.col("__first") + F.col("__before")).alias(name)))


def first_rows(df: DataFrame, n: int, position: str = "position") -> DataFrame:
    """The first ``n`` rows by position: a filter, nothing is ordered."""
    return df.where(F.col(position) < n)


def split_by_position(df: DataFrame, position: str = "position", ends: dict[str, float] = SPLIT_ENDS,
                      name: str = "split") -> DataFrame:
    """M2: consecutive shares of the rows, of exactly ``int(end * rows)`` boundaries (dense positions from 0)."""
    rows = df.count()
    out = None
    for split, end in ends.items():
        inside = F.col(position) < int(end * rows)
        out = F.when(inside, F.lit(split)) if out is None else out.when(inside, F.lit(split))
    return df.withColumn(name, out)
