"""Shared pieces: table reader, written intermediates, Arrow batch bounds, word splitting."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from farebox.session import scratch_path

# Rows of one Arrow batch.  Texts can be long, so a batch is bounded by few rows
# and, where the session knows the setting, by bytes.
BATCH_ROWS = 512
BATCH_BYTES = 16 * 1024 * 1024


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function from a batch to the output columns (any length)."""
    bound_batches(df.sparkSession)
    target = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, target)


def words(text: str | None) -> list[bytes]:
    """Maximal runs of anything but space and TAB..CR, as UTF-8 (``bytes.split`` cuts at exactly these six)."""
    return text.encode().split() if text else []
