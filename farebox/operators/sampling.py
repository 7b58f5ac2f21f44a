"""Sampling, first-n and splits.

Positions (``head``, ``iloc``, ``sample(random_state)``) have no meaning in a
distributed frame, so every row gets a content key hash and all choices are
made on it: re-runs and other engines pick the same rows.

``take_by_hash`` returns exactly ``n`` rows without funnelling candidates
through one task: ``orderBy().limit(n)`` would ship up to ``n`` rows from every
partition to a single reducer (``n x partitions`` rows at scale).  Instead the
n-th smallest hash is located with a few bounded histogram jobs over hash
prefixes, and the sample is a plain filter below that threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions import columns as C

HEX_DIGITS_PER_LEVEL = 4  # 65,536 histogram cells per level
FINAL_TAKE_ROWS = 50_000  # boundary cell resolved with an ordered take of at most this many keys
SPLIT_MODULUS = 10_000


def key_hash(key_cols: list[str], seed: int | str = 42) -> Column:
    """md5 hex of the key columns and the seed (computable in DuckDB as well)."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))))


def hash_threshold(hashes: DataFrame, n: int, col: str = "h") -> str | None:
    """Smallest hash ``t`` such that exactly ``n`` rows have ``h <= t``.

    Walks hash prefixes 4 hex digits at a time; each level is one aggregate
    returning at most 65,536 counts (the first level also gives the row
    count).  The boundary cell is resolved with an ordered take once it holds
    at most ``FINAL_TAKE_ROWS`` rows.  Returns None when there are ``<= n`` rows.
    """
    prefix, before, cell_total = "", 0, None  # cell prefix; rows sorting before the cell; rows in it
    while True:
        cell = hashes.where(F.col(col).startswith(prefix)) if prefix else hashes
        if len(prefix) >= 32:  # one hash value holds the boundary: its tie group is kept whole
            return prefix
        if cell_total is not None and cell_total <= FINAL_TAKE_ROWS:
            rows = cell.select(col).orderBy(col).limit(n - before).collect()
            return rows[-1][0]
        level_len = len(prefix) + HEX_DIGITS_PER_LEVEL
        hist = (cell.groupBy(F.substring(col, 1, level_len).alias("p"))
                .agg(F.count(F.lit(1)).alias("c")).orderBy("p").collect())
        if cell_total is None and sum(r["c"] for r in hist) <= n:
            return None
        for r in hist:
            if before + r["c"] >= n:
                prefix, cell_total = r["p"], r["c"]
                break
            before += r["c"]


def take_by_hash(df: DataFrame, n: int, key_cols: list[str], seed: int | str = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, those with the smallest key hash.

    Where rows share the boundary key hash, those whose whole content sorts first are taken
    (of identical rows, any), so the count is exact for repeated keys as well.
    """
    h = key_hash(key_cols, seed)
    hashes = df.select(h.alias("h"))
    t = hash_threshold(hashes, n)
    if t is None:
        return df
    row = hashes.agg(F.count_if(F.col("h") < t).alias("below"), F.count_if(F.col("h") == t).alias("at")).first()
    if row["below"] + row["at"] == n:
        return df.where(h <= F.lit(t))
    ties = df.where(h == F.lit(t)).orderBy(F.to_json(F.struct(*df.columns))).limit(n - row["below"])
    return df.where(h < F.lit(t)).unionAll(ties)


def approx_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample (size approximate, rows independent of partitioning only with a fixed input)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def with_split(df: DataFrame, key: str, train: float = 0.70, validation: float = 0.15,
               col: str = "split") -> DataFrame:
    """M2: 70/15/15 by a key hash bucket.

    Membership is a pure function of the key (no shuffle, re-runnable); sizes
    are near, not exactly, 70/15/15.
    """
    b = C.hash_bucket(key, SPLIT_MODULUS)
    t1 = int(round(train * SPLIT_MODULUS))
    t2 = int(round((train + validation) * SPLIT_MODULUS))
    return df.withColumn(
        col, F.when(b < t1, F.lit("train")).when(b < t2, F.lit("validation")).otherwise(F.lit("test")))


def split_frames(df: DataFrame, key: str, **kw) -> dict[str, DataFrame]:
    s = with_split(df, key, **kw)
    return {name: s.where(F.col("split") == name).drop("split") for name in ("train", "validation", "test")}
