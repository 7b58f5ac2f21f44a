"""Labeling manifests.

A manifest is JSON lines, one object per item: ``{"source-ref": "<uri>"}``.
The augmented manifest returned by a labeling job carries the label attribute
next to the reference.  Both are plain text/JSON datasets here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.operators.enrich import DEFAULT_BROADCAST_ROWS, checked_broadcast

SOURCE_REF = "source-ref"
MANIFEST_SCHEMA = T.StructType([T.StructField(SOURCE_REF, T.StringType(), True)])


def manifest_lines(items: DataFrame, ref: F.Column) -> DataFrame:
    """K9: one JSON object per item, ``{"source-ref": ref}``, in a ``value`` text column."""
    return items.select(F.to_json(F.struct(ref.alias(SOURCE_REF))).alias("value"))


def write_manifest(items: DataFrame, ref: F.Column, path: str) -> str:
    manifest_lines(items, ref).write.mode("overwrite").text(path)
    return path


def read_manifest(spark: SparkSession, path: str, label_attribute: str | None = None,
                  label_type: T.DataType = T.IntegerType()) -> DataFrame:
    """Read a (possibly augmented) manifest with an explicit schema (no inference pass)."""
    schema = MANIFEST_SCHEMA
    if label_attribute:
        schema = T.StructType([*MANIFEST_SCHEMA.fields, T.StructField(label_attribute, label_type, True)])
    return spark.read.schema(schema).json(path)


def augment(manifest: DataFrame, labels: DataFrame, label_attribute: str,
            max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Attach labels to manifest items by reference (left join; unlabeled items keep a null)."""
    lab, _ = checked_broadcast(labels.select(SOURCE_REF, label_attribute), SOURCE_REF, max_broadcast_rows)
    return manifest.join(lab, on=SOURCE_REF, how="left")


def write_augmented(augmented: DataFrame, label_attribute: str, path: str) -> str:
    """Augmented manifest out: ``{"source-ref": ..., "<label>": ...}`` per line (nulls omitted)."""
    augmented.select(F.to_json(F.struct(F.col(SOURCE_REF), F.col(label_attribute))).alias("value")) \
        .write.mode("overwrite").text(path)
    return path
