"""Aggregations.

Every aggregate here is a ``groupBy``/``agg`` with partial (map-side)
aggregation, so a hot key is combined inside each task before the shuffle.
AUC is computed exactly without a single-task global sort or sketch: scores
are first aggregated per distinct value, then dealt out by ranges and ranked
inside each range, with offsets from a table of one row per range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.session import scratch_path


MAX_REPEATED_DIGESTS = 16_000_000   # 8 bytes each: at most 128 MB to broadcast


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and return a scan of it."""
    path = scratch_path(df.sparkSession, "tables", name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """A1 as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def positive_rate(df: DataFrame, label: str = "high_tip") -> DataFrame:
    """A3: share of rows with label 1."""
    return df.agg(F.avg(F.col(label).cast("double")).alias("positive_rate"), F.count(F.lit(1)).alias("rows"))


def drop_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """A4: exact duplicate removal, by digest first.

    64-bit digests of the rows (combined before the shuffle) tell which are
    repeated; only rows with a repeated digest are moved and compared column by
    column, so equal digests of different rows do no harm.
    The repeated digests are broadcast behind a size check; beyond it, and with
    ``subset``, whole rows go through the grouped aggregate, in which copies
    of a row also meet in the task that read them first.
    """
    if subset:
        return df.dropDuplicates(subset)
    columns = [F.col(f"`{c}`") for c in df.columns]
    digest = F.xxhash64(*columns)
    repeated = df.groupBy(digest.alias("__repeated")).agg(F.count("*").alias("n")).where("n > 1")
    repeated = materialize(repeated.select("__repeated"), "repeated_digests")
    if repeated.count() > MAX_REPEATED_DIGESTS:
        return df.dropDuplicates()
    marked = df.select("*", digest.alias("__digest"))
    on = F.col("__digest") == F.col("__repeated")
    once = marked.join(F.broadcast(repeated), on, "left_anti").select(*columns)
    more = marked.join(F.broadcast(repeated), on, "left_semi").select(*columns)
    return once.unionAll(more.dropDuplicates())


def predicted_label(score: str = "score", threshold: float = 0.5):
    return (F.col(score) >= F.lit(threshold)).cast("int")


def accuracy(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """A5: accuracy of ``score >= threshold`` against the 0/1 label."""
    hit = (predicted_label(score, threshold) == F.col(label).cast("int")).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("rows"))


def auc_by(df: DataFrame, groups: list[str], label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """A6 (+A5): exact ROC AUC with ties counted half (Mann-Whitney form), one row per group (one in all without groups).

    1. per (group, distinct score): positives and negatives (partial aggregation);
    2. those rows are dealt out by ranges of (group, score) and written with
       their range as cell, so cells are in score order and of even size,
       whatever the distribution of the scores;
    3. negatives before a row: those of the group's earlier cells (a table of
       groups x cells) and those before it inside its cell (a window per cell);
    4. AUC = sum(pos * (neg_below + neg/2)) / (P * N).

    The same rows give the accuracy at ``threshold`` (a score row is right for
    its positives when ``s >= threshold``, else for its negatives).  Rows with a
    null or NaN score or a null label have no place in the ranking: they are
    left out of all metrics and counted in ``excluded``.  Group columns must not be null.
    """
    y = F.col(label).cast("int")
    s = F.col(score).cast("double")
    usable = s.isNotNull() & ~F.isnan(s) & y.isNotNull()
    per_score = df.groupBy(*groups, F.when(usable, s + F.lit(0.0)).alias("s")).agg(
        F.count_if(~usable).alias("excluded"),
        F.count_if(usable & (y == 1)).cast("double").alias("pos"), F.count_if(usable & (y == 0)).cast("double").alias("neg"))
    cells = materialize(per_score.repartitionByRange(*groups, "s").withColumn("cell", F.spark_partition_id()), "auc_cells")
    earlier = Window.partitionBy(*groups).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    per_cell = cells.groupBy(*groups, "cell").agg(F.sum("neg").alias("n"))
    per_cell = per_cell.select(*groups, "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0.0)).alias("neg_earlier"))
    within = Window.partitionBy(*groups, "cell").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = cells.withColumn("neg_inside", F.coalesce(F.sum("neg").over(within), F.lit(0.0))).join(per_cell, [*groups, "cell"])
    below = F.col("neg_earlier") + F.col("neg_inside")
    return ranked.groupBy(*groups).agg(
        F.try_divide(F.sum(F.col("pos") * (below + F.col("neg") / 2)), F.sum("pos") * F.sum("neg")).alias("auc"),
        F.try_divide(F.sum(F.when(F.col("s") >= F.lit(threshold), F.col("pos")).otherwise(F.col("neg"))),
                     F.sum(F.col("pos") + F.col("neg"))).alias("accuracy"),
        F.sum("pos").cast("bigint").alias("positives"),
        F.sum("neg").cast("bigint").alias("negatives"),
        F.coalesce(F.sum("excluded"), F.lit(0)).cast("bigint").alias("excluded"))


def auc(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """A6 (+A5): :func:`auc_by` over all rows; one row, with null metrics for an empty frame."""
    return auc_by(df, [], label, score, threshold)


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    """A11."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"))


def distinct_categories(df: DataFrame, columns: list[str], max_categories: int = 1000) -> dict[str, list]:
    """Sorted distinct non-null values per column.

    One ``groupBy`` per column (partial aggregation; the shuffle carries one row
    per value per task).  The result must come to the driver to build the
    encoding expressions, so its size is bounded: more than ``max_categories``
    values in a column raises instead of truncating.
    """
    if not columns:
        return {}
    # one job for all columns: (column, value) pairs, deduplicated with a partial aggregate
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                for c in columns])).alias("p")
    cap = max_categories * len(columns) + 1
    vals = (df.select(pairs).where(F.col("p.v").isNotNull()).groupBy("p.c", "p.v").agg(F.count(F.lit(1)))
            .select("c", "v").limit(cap).collect())
    out = {c: [] for c in columns}
    for r in vals:
        out[r["c"]].append(r["v"])
    types = dict(df.dtypes)
    for c in columns:
        if len(out[c]) > max_categories or len(vals) >= cap:
            raise ValueError(f"column {c!r} has more than {max_categories} categories")
        if types[c] != "string":  # restore the column's own type for sorting and comparison
            out[c] = [r[0] for r in df.sparkSession.createDataFrame([(v,) for v in out[c]], "v string")
                      .select(F.col("v").cast(types[c])).collect()]
        out[c] = sorted(out[c])
    return out


def profile(df: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """One row per column: non-null count, null count, distinct count, min, max (as text).

    Approximate distinct counts: one aggregate job, whose wide result is turned long
    with ``stack``.  Exact ones: see :func:`exact_profile`.
    """
    if exact_distinct:
        return exact_profile(df)
    aggs = []
    for c in df.columns:
        col = F.col(c)
        aggs += [F.count(col).alias(f"{c}__nn"), F.count_if(col.isNull()).alias(f"{c}__nul"),
                 F.approx_count_distinct(col).alias(f"{c}__nd"), F.min(col).cast("string").alias(f"{c}__min"),
                 F.max(col).cast("string").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    parts = ", ".join(
        f"'{c}', `{c}__nn`, `{c}__nul`, `{c}__nd`, `{c}__min`, `{c}__max`" for c in df.columns)
    return wide.selectExpr(
        f"stack({len(df.columns)}, {parts}) AS (column_name, non_null, nulls, distinct_values, min_value, max_value)")


# Types whose values are grouped and compared as they are; others are counted by their text, as equal values may differ in it.
_OWN_VALUES = ("boolean", "tinyint", "smallint", "int", "bigint", "string", "binary", "date", "timestamp", "timestamp_ntz")


def exact_profile(df: DataFrame) -> DataFrame:
    """A7 with exact distinct counts: one grouping per column over its own values, which gives all of the column's numbers.

    Values are counted inside each task first, so a column of few values costs a
    look-up per row; no row is copied or turned into text.  Each grouping reads its
    column alone from a table; write a frame that is costly to compute as a table
    first (:func:`materialize`).
    """
    def one(name: str, dtype: str) -> DataFrame:
        raw = F.col(f"`{name}`")
        if dtype in _OWN_VALUES or dtype.startswith("decimal"):
            v, low, high = raw, F.col("v"), F.col("v")
            groups = df.select(v.alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        else:       # floats are grouped with -0.0 as 0.0, but keep their bounds
            v, low, high = raw if dtype in ("float", "double") else raw.cast("string"), F.col("low"), F.col("high")
            groups = df.select(v.alias("v"), raw.alias("x")).groupBy("v").agg(
                F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        there = F.col("v").isNotNull()
        return groups.agg(
            F.coalesce(F.sum(F.when(there, F.col("n"))), F.lit(0)).cast("long").alias("non_null"),
            F.coalesce(F.sum(F.when(~there, F.col("n"))), F.lit(0)).cast("long").alias("nulls"),
            F.count("v").alias("distinct_values"), F.min(low).cast("string").alias("min_value"),
            F.max(high).cast("string").alias("max_value")).select(F.lit(name).alias("column_name"), "*")

    return reduce(DataFrame.unionAll, [one(c, t) for c, t in df.dtypes])
