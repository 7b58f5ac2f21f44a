"""Projections and row filters.

All filters are plain predicates so Catalyst merges adjacent ones into a single
``Filter`` and pushes the column-only bounds (distance, fare, total, null
checks) into the Parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions import columns as C
from farebox.functions.names import sanitize_names

# ---------------------------------------------------------------- fixed values
# Raw TLC name -> snake_case name.
TRIP_RENAMES = {
    "tpep_pickup_datetime": "pickup_ts",
    "tpep_dropoff_datetime": "dropoff_ts",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "RatecodeID": "rate_code_id",
    "Airport_fee": "airport_fee",
}
REQUIRED_TRIP_FIELDS = ["pickup_ts", "dropoff_ts", "pu_location_id", "do_location_id"]
DURATION_MIN, DURATION_MAX = 1, 120  # minutes, both ends kept
DISTANCE_LOW, DISTANCE_HIGH = 0, 100  # miles, both ends excluded
SPEED_LOW, SPEED_HIGH = 0, 80  # mph, both ends excluded
VISUAL_FLOW_DROPPED = ["store_and_fwd_flag", "mta_tax", "improvement_surcharge"]
# ------------------------------------------------------------------------------


def rename_columns(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename; names missing from the frame are ignored."""
    mapping = TRIP_RENAMES if mapping is None else mapping
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def all_not_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def drop_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """drop rows with a null in any of ``subset``.

    Written as ``isNotNull`` conjunctions rather than ``na.drop`` because the
    latter compiles to ``AtLeastNNonNulls``, which Parquet cannot take as a
    pushed filter.  For float columns NaN also counts as missing, as in
    ``na.drop``.
    """
    subset = REQUIRED_TRIP_FIELDS if subset is None else subset
    dtypes = dict(df.dtypes)
    conds = []
    for c in subset:
        cond = F.col(c).isNotNull()
        if dtypes.get(c) in ("double", "float"):
            cond = cond & ~F.isnan(F.col(c))
        conds.append(cond)
    return df.filter(reduce(lambda a, b: a & b, conds))


def with_duration(df: DataFrame, exact: bool = False, start="pickup_ts", end="dropoff_ts") -> DataFrame:
    """P3 / P3b."""
    fn = C.duration_minutes_exact if exact else C.duration_minutes
    return df.withColumn("trip_duration_min", fn(start, end))


def duration_range(df: DataFrame, lo: float = DURATION_MIN, hi: float = DURATION_MAX) -> DataFrame:
    """``lo <= trip_duration_min <= hi``."""
    return df.filter(F.col("trip_duration_min").between(lo, hi))


def distance_range(df: DataFrame, lo: float = DISTANCE_LOW, hi: float = DISTANCE_HIGH) -> DataFrame:
    """``lo < trip_distance < hi``."""
    return df.filter((F.col("trip_distance") > lo) & (F.col("trip_distance") < hi))


def revenue_trips(df: DataFrame, check_total: bool = True) -> DataFrame:
    """positive fare (and total unless ``check_total=False``)."""
    cond = F.col("fare_amount") > 0
    if check_total:
        cond = cond & (F.col("total_amount") > 0)
    return df.filter(cond)


def with_speed(df: DataFrame) -> DataFrame:
    """P4."""
    return df.withColumn("trip_speed_mph", C.speed_mph())


def plausible_speed(df: DataFrame, lo: float = SPEED_LOW, hi: float = SPEED_HIGH) -> DataFrame:
    """``lo < trip_speed_mph < hi``; must follow P4."""
    return df.filter((F.col("trip_speed_mph") > lo) & (F.col("trip_speed_mph") < hi))


def with_calendar(df: DataFrame, ts: str = "pickup_ts", hour_only: bool = False) -> DataFrame:
    """P5: hour, day name and date of the pickup time."""
    cols = {"pickup_hour": C.pickup_hour(ts)}
    if not hour_only:
        cols["pickup_dow"] = C.pickup_dow(ts)
        cols["pickup_date"] = C.pickup_date(ts)
    return df.withColumns(cols)


def card_payments(df: DataFrame, by: str = "label") -> DataFrame:
    """card trips, by label (``payment_label``) or by code (``payment_type``)."""
    if by == "label":
        return df.filter(F.col("payment_label") == C.CARD_LABEL)
    return df.filter(F.col("payment_type") == C.CARD_CODE)


def complete_cases(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """any null (or NaN in a float column) drops the row."""
    return drop_missing(df, list(df.columns) if subset is None else subset)


def name_contains(df: DataFrame, column: str, text: str, prefix: bool = False) -> DataFrame:
    """F8: rows whose ``column`` contains ``text`` (or starts with it when ``prefix=True``).

    A prefix test is pushed to Parquet as ``StringStartsWith``.
    """
    cond = F.col(column).startswith(text) if prefix else F.col(column).contains(text)
    return df.filter(cond)


def drop_fields(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """P11 / P12."""
    return df.drop(*(VISUAL_FLOW_DROPPED if fields is None else fields))


def label_first(df: DataFrame, label: str) -> DataFrame:
    """Move ``label`` to position 0."""
    return df.select(label, *[c for c in df.columns if c != label])


def booleans_to_int(df: DataFrame) -> DataFrame:
    """Cast every boolean column to 0/1 int (null stays null)."""
    bools = {f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)}
    return df.select(*[F.col(c).cast("int").alias(c) if c in bools else F.col(c) for c in df.columns])


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Feature-store-safe names; raises on a collision."""
    return df.toDF(*sanitize_names(df.columns))
