"""Sources (S1-S12).

Readers take paths (any Hadoop filesystem URI) and return DataFrames.  Schemas
are given explicitly wherever the reference infers them: inference costs an
extra pass over the data.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.session import path_exists, scratch_path


def read_parquet(spark: SparkSession, path: str | list[str], recursive: bool = False,
                 columns: list[str] | None = None) -> DataFrame:
    """Scan one or many Parquet paths; ``columns`` prunes the ``ReadSchema``."""
    reader = spark.read.option("recursiveFileLookup", "true") if recursive else spark.read
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.parquet(*paths)
    return df.select(*columns) if columns else df


def read_partitioned(spark: SparkSession, path: str, columns: list[str] | None = None,
                     predicate: Column | None = None) -> DataFrame:
    """Hive-partitioned scan with projection and predicate.

    Catalyst prunes partitions for predicates on the partition column and
    pushes the others into the Parquet reader.  The partition column comes
    back as the last column.
    """
    df = spark.read.option("basePath", path).parquet(path)
    if predicate is not None:
        df = df.where(predicate)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, header: bool = True, schema: T.StructType | str | None = None,
             infer: bool = False) -> DataFrame:
    """CSV with or without header.

    ``nullValue`` is left unset so the literal text ``N/A`` stays a value.
    With ``schema`` given, no inference pass runs; ``infer=True`` keeps the
    reference's ``inferSchema`` behaviour (an extra pass).
    """
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


_ONE_FILE_A_TASK = str(1 << 40)   # above any file's size: files are neither split nor packed


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line): the first line of every non-empty ``*.csv`` file of a directory, written.

    One task per file reads its first rows and stops; the driver opens no file.
    """
    sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in sizes}
    out = scratch_path(spark, "first_lines")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    rows = spark.read.option("pathGlobFilter", "*.csv").text(path).select(F.col("_metadata.file_path").alias("file"),
                                                                          F.col("value").alias("line"))
    try:
        for k in sizes:
            spark.conf.set(k, _ONE_FILE_A_TASK)
        rows.mapInArrow(run, "file string, line string").write.parquet(out)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema("file string, line string").parquet(out)


def channel_layouts(spark: SparkSession, path: str) -> dict[tuple[str, ...] | int, list[str]]:
    """S7 helper: files by layout, which is the header's names, or the number of columns of a file without one.

    A first line is a header if a token neither casts to a number nor is empty (a missing
    value).  Layouts are reduced in Spark; the driver gets them and the names of their files.
    """
    tokens = F.transform(F.split(F.trim("line"), ","), F.trim)
    header = F.exists(tokens, lambda t: (t != "") & t.try_cast("double").isNull())
    found = (first_lines(spark, path)
             .select("file", F.when(header, tokens).alias("names"), F.size(tokens).alias("width"))
             .groupBy("names", "width").agg(F.sort_array(F.collect_list("file")).alias("files")))
    return {tuple(r.names) if r.names is not None else r.width: [unquote(f) for f in r.files] for r in found.collect()}


def read_channel(spark: SparkSession, path: str) -> DataFrame:
    """Header-detecting CSV read of a training channel, all columns as double.

    Files whose headers list the same names in another order are read by name.
    Columns of files without header are ``_c0, _c1, ...`` (``_c0`` is the label).  A
    channel whose files disagree otherwise raises, as does one without a non-empty file.
    """
    layouts = channel_layouts(spark, path) if path and path_exists(spark, path) else {}
    if not layouts:
        raise FileNotFoundError(f"nothing to read in {path!r}")
    kinds = {k if isinstance(k, int) else tuple(sorted(k)) for k in layouts}
    if len(kinds) > 1:
        raise ValueError(f"files of {path!r} have different columns: {sorted(map(str, kinds))}")
    parts = []
    for layout, files in sorted(layouts.items(), key=lambda x: x[1]):
        names = [f"_c{i}" for i in range(layout)] if isinstance(layout, int) else list(layout)
        schema = T.StructType([T.StructField(n, T.DoubleType(), True) for n in names])
        parts.append(spark.read.option("header", str(not isinstance(layout, int)).lower()).schema(schema).csv(files))
    return reduce(DataFrame.unionByName, parts)


# Candidate types for inference, narrowest first (fixed order).
_INFER_ORDER = ["bigint", "double", "boolean", "timestamp_ntz"]


def _fits(v: Column, kind: str) -> Column:
    """Whether text casts to ``kind`` and loses nothing: no leading zeros, no overflow to infinity."""
    cast = v.try_cast(kind)
    fits = cast.isNotNull()
    if kind in ("bigint", "double"):
        fits = fits & ~v.rlike(r"^[+-]?0[0-9]")
    if kind == "double":
        fits = fits & ((F.abs(cast) < float("inf")) | F.isnan(cast) | v.rlike(r"(?i)^[+-]?inf(inity)?$"))
    return fits


def infer_types(df: DataFrame, sample_fraction: float | None = None, seed: int = 42) -> dict[str, str]:
    """S8 (part 1): per string column, the narrowest type every non-null value casts to.

    One aggregate job computes, for all columns and candidate types at once,
    how many non-null values fail ``try_cast``.  ``sample_fraction`` mimics the
    reference's sampled inference.
    """
    src = df.sample(False, sample_fraction, seed) if sample_fraction else df
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strings:
        return {}
    aggs = []
    for c in strings:
        v = F.trim(F.col(c))
        for t in _INFER_ORDER:
            bad = (v.isNotNull() & (v != "") & ~_fits(v, t)).cast("long")
            aggs.append(F.sum(bad).alias(f"{c}__{t}"))
    row = src.agg(*aggs).first()
    out = {}
    for c in strings:
        out[c] = next((t for t in _INFER_ORDER if not row[f"{c}__{t}"]), "string")
    return out


def infer_and_cast(df: DataFrame, sample_fraction: float | None = None) -> DataFrame:
    """Infer types (one job), then cast.

    A sample only proposes types: a second job over all rows widens to text every
    column in which a value does not fit, so no value is lost.  Empty text becomes null.
    """
    types = infer_types(df, sample_fraction)
    if sample_fraction and types:
        misfits = df.agg(*[F.count_if((F.trim(c) != "") & ~_fits(F.trim(c), t)).alias(c)
                           for c, t in types.items() if t != "string"] or [F.lit(0).alias("_")]).first().asDict()
        types = {c: "string" if misfits.get(c) else t for c, t in types.items()}
    return df.select(*[
        F.trim(F.col(c)).try_cast(types[c]).alias(c) if types.get(c, "string") != "string" else F.col(c)
        for c in df.columns])


def read_json_report(spark: SparkSession, path: str) -> DataFrame:
    """Metric report as a JSON string column ``report`` (one object per line)."""
    return spark.read.text(path).select(F.col("value").alias("report"))


def json_value(report: Column, dotted_path: str) -> Column:
    """Value at a dotted path, e.g. ``binary_classification_metrics.auc.value``."""
    return F.get_json_object(report, "$." + dotted_path)


def register_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Expose frames as catalog views so SQL text can read them."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def union_paths(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """Append many files with a projection (one scan over all paths)."""
    return reduce(lambda a, b: a.unionByName(b), [read_parquet(spark, p, columns=columns) for p in paths]) \
        if len(paths) > 1 else read_parquet(spark, paths[0], columns=columns)
