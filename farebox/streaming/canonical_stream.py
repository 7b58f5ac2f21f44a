"""The canonical transforms on a stream.

T1-T15 are stateless filters and projections plus stream-static left joins,
so the same functions accept a streaming DataFrame unchanged.  A file-source
``availableNow`` run processes everything present and stops; the Parquet sink
and the checkpoint live in shared storage, so a restarted driver or lost
executor resumes from the last committed batch (exactly-once file sink).

Aggregating operators (the borough report, duplicate removal) need complete
output mode or a watermark and stay batch-only, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from farebox.plans.canonical import build_pipeline


def stream_enriched(spark: SparkSession, trips_dir: str, schema: T.StructType, zones: DataFrame,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of enriched trips read from Parquet files under ``trips_dir``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return build_pipeline(reader.parquet(trips_dir), zones, keep=["trip_key"])


def run_available_now(spark: SparkSession, trips_dir: str, schema: T.StructType, zones: DataFrame,
                      out_dir: str, checkpoint_dir: str, timeout_s: int | None = None,
                      max_files_per_trigger: int = 1000) -> DataFrame:
    """Process all files present once (``availableNow``), write Parquet, return the written table.

    ``max_files_per_trigger`` bounds each micro-batch, so a large backlog is
    processed in several committed batches rather than one giant one.  Without
    ``timeout_s`` the run lasts as long as the backlog does.
    """
    q = (stream_enriched(spark, trips_dir, schema, zones, max_files_per_trigger=max_files_per_trigger)
         .writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start(out_dir))
    finished = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination()
    if finished is False:
        q.stop()
        raise TimeoutError("streaming run did not finish")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(spark.read.parquet(out_dir).schema).parquet(out_dir)
