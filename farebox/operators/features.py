"""Feature-group tables.

The reference defines a feature group from a pandas frame and ingests it into a
managed store.  Here a feature group is a Parquet table partitioned by event
date (the offline store) and the "online" view is a latest-record-per-id
aggregate over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions.names import is_valid_feature_name

# Spark type -> feature type of the store (fixed values of the store's type system).
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType, T.DecimalType)


def feature_definitions(df: DataFrame) -> list[tuple[str, str]]:
    """M4: ``(name, Integral|Fractional|String)`` per column, from the frame's schema.

    Booleans are rejected (the store cannot type them) and so are names that
    break the store's naming rule.
    """
    out = []
    for f in df.schema.fields:
        if not is_valid_feature_name(f.name):
            raise ValueError(f"invalid feature name {f.name!r}")
        if isinstance(f.dataType, T.BooleanType):
            raise TypeError(f"feature {f.name!r} is boolean; cast it to int first")
        if isinstance(f.dataType, INTEGRAL_TYPES):
            kind = "Integral"
        elif isinstance(f.dataType, FRACTIONAL_TYPES):
            kind = "Fractional"
        elif isinstance(f.dataType, T.StringType):
            kind = "String"
        else:
            raise TypeError(f"feature {f.name!r} has unsupported type {f.dataType.simpleString()}")
        out.append((f.name, kind))
    return out


def with_record_id(df: DataFrame, key_cols: list[str], name: str = "trip_id") -> DataFrame:
    """Stable string record id = md5 of the key columns (row position is not stable in Spark)."""
    return df.withColumn(name, F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])))


def with_event_time(df: DataFrame, load_ts: float, name: str = "event_time") -> DataFrame:
    """One epoch-seconds double per load; the caller passes it so re-runs agree."""
    return df.withColumn(name, F.lit(float(load_ts)).cast("double"))


def validate_group(df: DataFrame, record_id: str, event_time: str) -> DataFrame:
    """M5 guard: both required columns exist and are never null.

    The null check is part of the plan (no pass of its own): the job that reads
    or writes the result fails at a record without id or event time.
    """
    for c in (record_id, event_time):
        if c not in df.columns:
            raise ValueError(f"feature group needs column {c!r}")
    feature_definitions(df)
    return df.withColumns({
        c: F.coalesce(F.col(c), F.raise_error(F.lit(f"a record lacks {c}")).cast(df.schema[c].dataType))
        for c in (record_id, event_time)})


def ingest(df: DataFrame, path: str, record_id: str = "trip_id", event_time: str = "event_time") -> str:
    """M5 / K8: append to the offline store partitioned by event date, validated during the write."""
    out = validate_group(df, record_id, event_time)
    out = out.withColumn("event_date", F.to_date(F.timestamp_seconds(F.col(event_time))))
    out.write.mode("append").partitionBy("event_date").parquet(path)
    return path


def described_features(df: DataFrame) -> DataFrame:
    """M4 with data: (feature_name, feature_type, n_values) per column, non-null values counted in one aggregate."""
    kinds = feature_definitions(df)
    counts = df.agg(*[F.count(F.col(name)).alias(name) for name, _ in kinds])
    rows = F.array(*[F.struct(F.lit(name).alias("feature_name"), F.lit(kind).alias("feature_type"),
                              F.col(name).alias("n_values")) for name, kind in kinds])
    return counts.select(F.inline(rows))


def latest_records(df: DataFrame, record_id: str, event_time: str) -> DataFrame:
    """M6: the newest row per record id; ties on event time broken by the other columns.

    ``max(struct(event_time, ...))`` per id is an aggregate with a map-side
    partial step, so a record id holding a third of all rows is reduced inside
    each task before the shuffle (a ``row_number`` window would sort that
    whole group in one task).
    """
    others = [c for c in df.columns if c not in (record_id, event_time)]
    best = F.max(F.struct(F.col(event_time), *[F.col(c) for c in others])).alias("_best")
    return df.groupBy(record_id).agg(best).select(
        record_id, *[F.col(f"_best.{c}").alias(c) for c in [event_time, *others]])
