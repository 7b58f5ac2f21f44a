"""The canonical trip pipeline (T1-T15) and the T16 label.

Plan shape (checked with ``explain``): one Parquet scan with the null and
range bounds pushed down, one merged Filter for the derived bounds, two
broadcast hash joins against the checked zone dimension, one Project.  No
shuffle before the write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions import columns as C
from farebox.operators import cleaning as CL
from farebox.operators.enrich import DEFAULT_BROADCAST_ROWS, enrich_locations

# ---------------------------------------------------------------- fixed values
# T15 output contract: exactly these 20 columns in this order.
ENRICHED_COLUMNS = [
    "pickup_ts", "dropoff_ts", "pickup_date", "pickup_hour", "pickup_dow",
    "passenger_count", "trip_distance", "trip_distance_bucket", "trip_duration_min",
    "trip_speed_mph", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone",
    "is_airport_trip", "payment_label", "fare_amount", "tip_amount", "tip_pct", "total_amount",
]
# ------------------------------------------------------------------------------


def clean_trips(trips: DataFrame) -> DataFrame:
    """Rename, drop missing, duration, range filters, speed."""
    df = CL.rename_columns(trips)
    df = CL.drop_missing(df)
    df = CL.with_duration(df)
    df = CL.duration_range(df)
    df = CL.distance_range(df)
    df = CL.revenue_trips(df)
    df = CL.with_speed(df)
    return CL.plausible_speed(df)


def derive_features(df: DataFrame) -> DataFrame:
    """T9-T13 as one projection."""
    df = CL.with_calendar(df)
    return df.withColumns({
        "payment_label": C.payment_label(),
        "tip_pct": C.tip_pct(),
        "trip_distance_bucket": C.distance_band(),
        "is_airport_trip": C.airport_flag(),
    })


def build_pipeline(trips: DataFrame, zones: DataFrame, keep: list[str] | None = None,
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """T1-T15.  ``keep`` adds pass-through columns (e.g. ``trip_key``) after the contract columns."""
    df = derive_features(clean_trips(trips))
    df = enrich_locations(df, zones, max_broadcast_rows)
    extra = [c for c in (keep or []) if c not in ENRICHED_COLUMNS]
    return df.select(*ENRICHED_COLUMNS, *extra)


ZONES_CSV_SCHEMA = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"


def build_pipeline_from_paths(spark, trips_path: str, zones_path: str, infer_zones_schema: bool = False,
                              recursive: bool = True) -> DataFrame:
    """The reference's entry shape: raw trips Parquet + zone lookup CSV (with header) -> T1-T15.

    The zone CSV is read with an explicit schema unless ``infer_zones_schema``
    (inference costs an extra pass); ``N/A`` stays a value.
    """
    from farebox.sources.readers import read_csv, read_parquet

    trips = read_parquet(spark, trips_path, recursive=recursive)
    zones = read_csv(spark, zones_path, header=True, infer=infer_zones_schema,
                     schema=None if infer_zones_schema else ZONES_CSV_SCHEMA)
    return build_pipeline(trips, zones)


def add_ml_label(df: DataFrame) -> DataFrame:
    """``high_tip`` = (tip_pct > 20) as int, NULL kept."""
    return df.withColumn("high_tip", C.high_tip())


def borough_tip_report(enriched: DataFrame) -> DataFrame:
    """A2 + L1: mean tip % (2 places) and trip count per pickup borough, best first.

    ``groupBy`` compiles to a partial (map-side) + final hash aggregate, so a hot
    borough collapses to one row per task before the shuffle.  Null borough is
    its own group.
    """
    return (
        enriched.groupBy("pickup_borough")
        .agg(F.round(F.avg("tip_pct"), 2).alias("avg_tip_pct"), F.count(F.lit(1)).alias("trips"))
        .orderBy(F.desc("avg_tip_pct"), F.asc_nulls_last("pickup_borough"))
    )
