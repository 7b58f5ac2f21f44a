"""The two supervised-table builders (M3, M3b) and the visual flow.

They differ on purpose -- kept apart and named (SURVEY §2.12):

* dataset A (:func:`one_hot_dataset`) starts from the enriched table, keeps card
  rows by label, samples **before** the complete-case filter and one-hot
  encodes the distance band and pickup borough;
* dataset B (:func:`fixed_feature_dataset`) starts from raw trips, uses
  sub-second durations, checks fare only, never joins zones, filters complete
  cases **before** sampling and keeps 7 fixed features.

Row positions are replaced by a hash of ``trip_key``: sampling picks the
smallest hashes, the split is a hash bucket.  Both are deterministic.  By
default a dataset holds every row, so evaluation, bias, attributions and
feature ingest see the whole data, and so do tuning and the job models; only the
candidates' fits bound their rows (``learn.FIT_ROWS``).  ``sample_rows`` cuts the dataset itself where that is
wanted.  The rows are written once to the shared folder, so everything
downstream reads that table instead of re-running the pipeline from the raw scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions import columns as C
from farebox.operators import cleaning as CL
from farebox.operators.aggregate import drop_duplicates, materialize
from farebox.operators.encode import one_hot
from farebox.operators.sampling import take_by_hash, with_split

# ---------------------------------------------------------------- fixed values
LABEL = "high_tip"
NUMERIC = ["trip_distance", "trip_duration_min", "trip_speed_mph", "pickup_hour", "passenger_count", "fare_amount"]
CATEGORICAL = ["trip_distance_bucket", "pickup_borough"]
BOOL = ["is_airport_trip"]
FIXED_FEATURES = ["trip_distance", "trip_duration_min", "trip_speed_mph", "pickup_hour",
                  "passenger_count", "fare_amount", "is_airport_trip"]
SAMPLE_SEED = 42
KEY = "trip_key"
# ------------------------------------------------------------------------------


def _sampled(df: DataFrame, sample_rows: int | None, key: str) -> DataFrame:
    return df if sample_rows is None else take_by_hash(df, sample_rows, [key], SAMPLE_SEED)


def one_hot_dataset(enriched: DataFrame, sample_rows: int | None = None, categories: dict | None = None,
                    key: str = KEY) -> DataFrame:
    """M3: F6(label) -> P10b -> P12 -> L5 (if asked for) -> P15 -> M1 -> F7 -> P13 -> M2.

    ``enriched`` must carry ``key``.  Returns ``key, split, high_tip, features...``.
    """
    cols = NUMERIC + CATEGORICAL + BOOL + ["payment_label", "tip_pct", key]
    df = CL.card_payments(enriched.select(*cols), by="label")
    df = df.withColumn(LABEL, C.high_tip_01()).drop("payment_label", "tip_pct")
    # written once: category discovery and the final projection read it instead
    # of re-running the whole pipeline from the raw scan
    df = materialize(_sampled(df, sample_rows, key), "dataset_a_rows")
    df = CL.booleans_to_int(df)
    df = one_hot(df, CATEGORICAL, categories)
    df = CL.complete_cases(df)
    df = CL.label_first(df, LABEL)
    df = with_split(df, key)
    return df.select(key, "split", *[c for c in df.columns if c not in (key, "split")])


def fixed_feature_rows(trips: DataFrame, key: str = KEY) -> DataFrame:
    """M3b before sampling: F1(2) -> P3b -> F2,F3,F4(fare) -> P4 -> F5 -> P5(hour) -> P9b -> F6(code) -> P7b -> P10b -> F7."""
    df = CL.drop_missing(trips, ["tpep_pickup_datetime", "tpep_dropoff_datetime"])
    df = CL.with_duration(df, exact=True, start="tpep_pickup_datetime", end="tpep_dropoff_datetime")
    df = CL.duration_range(df)
    df = CL.distance_range(df)
    df = CL.revenue_trips(df, check_total=False)
    df = CL.with_speed(df)
    df = CL.plausible_speed(df)
    df = df.withColumns({
        "pickup_hour": C.pickup_hour("tpep_pickup_datetime"),
        "is_airport_trip": C.airport_flag_01("Airport_fee", "RatecodeID"),
    })
    df = CL.card_payments(df, by="code")
    df = df.withColumn("tip_pct", C.tip_pct(rounded=False))
    df = df.withColumn(LABEL, C.high_tip_01())
    return CL.complete_cases(df.select(key, LABEL, *FIXED_FEATURES))


def fixed_feature_dataset(trips: DataFrame, sample_rows: int | None = None, key: str = KEY) -> DataFrame:
    """:func:`fixed_feature_rows` -> L5 (complete cases **before** the sample) -> M2."""
    df = fixed_feature_rows(trips, key)
    df = materialize(_sampled(df, sample_rows, key), "dataset_b_rows")
    df = with_split(df, key)
    return df.select(key, "split", LABEL, *FIXED_FEATURES)


def visual_flow(trips: DataFrame) -> DataFrame:
    """M21 (before the write): A4 exact duplicates -> P11 drop three fields."""
    return CL.drop_fields(drop_duplicates(trips))


def split_of(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name).drop("split")
