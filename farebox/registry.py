"""Registered queries: one per operator of SURVEY §2, each with its DuckDB twin.

Every callable takes ``(spark, sf_dir)``, reads the driver tables (through the
trip-shaped views of :mod:`farebox.fixtures`) and returns a DataFrame over the
whole input.  Write-then-read queries write under the session's shared
checkpoint folder.  ``ORACLE`` holds the DuckDB SQL for every query that SQL
can express; queries without an entry get the driver's rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox import fixtures as X
from farebox.functions import columns as C
from farebox.operators import aggregate as A
from farebox.operators import bias as B
from farebox.operators import cleaning as CL
from farebox.operators import compare as U
from farebox.operators import enrich as J
from farebox.operators import explain as EX
from farebox.operators import features as FS
from farebox.operators import labeling as LB
from farebox.operators import learn as L
from farebox.operators import positions as PO
from farebox.operators import runs as R
from farebox.operators import sampling as S
from farebox.operators import tree_shap as TS
from farebox.operators.encode import one_hot
from farebox.oracle import A_DUMMY_NAMES, B_FEATURES, PAYMENT_CASES, fixed_score_sql, sample_qualify, split_sql, with_ctes
from farebox.plans import canonical as P
from farebox.plans import ml_tables as M
from farebox.plans import model_flow as MF
from farebox.session import scratch_path
from farebox.sources import readers as RD
from farebox.sources import writers as WR
from farebox.streaming.canonical_stream import run_available_now

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

METRIC_DIGITS = 10  # doubles derived through exp/log/division are compared at this many decimals


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ shared frames

def trips(spark, d):
    return X.trips(spark, d)


def zones(spark, d):
    return X.zones(spark, d)


def renamed(spark, d):
    return CL.rename_columns(trips(spark, d))


def f1(spark, d):
    return CL.drop_missing(renamed(spark, d))


def f2(spark, d):
    return CL.duration_range(CL.with_duration(f1(spark, d)))


def f4(spark, d):
    return CL.revenue_trips(CL.distance_range(f2(spark, d)))


def enriched(spark, d):
    return P.build_pipeline(trips(spark, d), zones(spark, d), keep=["trip_key"])


def dataset_a(spark, d):
    return M.one_hot_dataset(enriched(spark, d))


def dataset_b(spark, d):
    return M.fixed_feature_dataset(trips(spark, d))


def scored_test(spark, d):
    return MF.with_fixed_score(M.split_of(dataset_b(spark, d), "test"))


def _round_doubles(df: DataFrame, digits: int = METRIC_DIGITS, unsigned_zero: bool = False) -> DataFrame:
    """Round double columns; ``unsigned_zero`` adds 0.0 so -0.0 becomes 0.0 (IEEE), as the SQL twin does."""
    def r(c):
        x = F.round(F.col(c), digits)
        return x + F.lit(0.0) if unsigned_zero else x
    return df.select(*[r(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _round_sql(cols: list[str], digits: int = METRIC_DIGITS) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


# ------------------------------------------------------------------ M20 / flagship

@register("m20_canonical_enriched", with_ctes("SELECT * FROM enriched", "enriched"))
def q_m20(spark, d):
    return enriched(spark, d)


@register("a2_l1_borough_tip_report", with_ctes("""
    SELECT pickup_borough, round(avg(tip_pct), 2) AS avg_tip_pct, count(*) AS trips
    FROM enriched GROUP BY pickup_borough ORDER BY avg_tip_pct DESC""", "enriched"))
def q_a2(spark, d):
    return P.borough_tip_report(enriched(spark, d))


# ------------------------------------------------------------------ projections P1-P18

@register("p1_rename", with_ctes("SELECT * FROM renamed", "renamed"))
def q_p1(spark, d):
    return renamed(spark, d)


@register("p2_final_projection", with_ctes("SELECT * EXCLUDE (trip_key) FROM enriched", "enriched"))
def q_p2(spark, d):
    return P.build_pipeline(trips(spark, d), zones(spark, d))


@register("p3_duration_minutes", with_ctes(
    "SELECT trip_key, (epoch(dropoff_ts) - epoch(pickup_ts)) / 60.0 AS trip_duration_min FROM renamed", "renamed"))
def q_p3(spark, d):
    return CL.with_duration(renamed(spark, d)).select("trip_key", "trip_duration_min")


@register("p3b_duration_minutes_exact", with_ctes(
    "SELECT trip_key, CAST(epoch_us(dropoff_ts) - epoch_us(pickup_ts) AS DOUBLE) / 60000000.0 AS trip_duration_min "
    "FROM renamed", "renamed"))
def q_p3b(spark, d):
    return CL.with_duration(renamed(spark, d), exact=True).select("trip_key", "trip_duration_min")


@register("p4_speed_mph", with_ctes(
    "SELECT trip_key, trip_distance / (trip_duration_min / 60.0) AS trip_speed_mph FROM f2", "f2"))
def q_p4(spark, d):
    return CL.with_speed(f2(spark, d)).select("trip_key", "trip_speed_mph")


@register("p5_calendar", with_ctes(
    "SELECT trip_key, CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour, dayname(pickup_ts) AS pickup_dow, "
    "CAST(pickup_ts AS DATE) AS pickup_date FROM renamed", "renamed"))
def q_p5(spark, d):
    return CL.with_calendar(renamed(spark, d)).select("trip_key", "pickup_hour", "pickup_dow", "pickup_date")


@register("p5_calendar_events", """
    SELECT event_id, CAST(hour(ts) AS INTEGER) AS pickup_hour, dayname(ts) AS pickup_dow,
           CAST(ts AS DATE) AS pickup_date FROM events""")
def q_p5e(spark, d):
    return CL.with_calendar(X.table(spark, d, "events"), ts="ts").select(
        "event_id", "pickup_hour", "pickup_dow", "pickup_date")


@register("p6_payment_label", with_ctes(
    "SELECT trip_key, payment_type, payment_label FROM (SELECT *, CASE "
    + PAYMENT_CASES + " ELSE 'Unknown' END AS payment_label FROM trips)", "trips"))
def q_p6(spark, d):
    return trips(spark, d).select("trip_key", "payment_type", C.payment_label().alias("payment_label"))


@register("p7_tip_pct", with_ctes(
    "SELECT trip_key, CASE WHEN fare_amount > 0 THEN round(tip_amount / fare_amount * 100, 2) ELSE 0.0 END "
    "AS tip_pct FROM trips", "trips"))
def q_p7(spark, d):
    return trips(spark, d).select("trip_key", C.tip_pct().alias("tip_pct"))


@register("p7b_tip_pct_unrounded", with_ctes(
    "SELECT trip_key, CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 ELSE 0.0 END "
    "AS tip_pct FROM trips", "trips"))
def q_p7b(spark, d):
    return trips(spark, d).select("trip_key", C.tip_pct(rounded=False).alias("tip_pct"))


@register("p8_distance_band", with_ctes(
    "SELECT trip_key, trip_distance, CASE WHEN trip_distance < 2 THEN 'short' WHEN trip_distance < 5 THEN 'medium' "
    "WHEN trip_distance < 10 THEN 'long' ELSE 'very_long' END AS trip_distance_bucket FROM trips", "trips"))
def q_p8(spark, d):
    return trips(spark, d).select("trip_key", "trip_distance", C.distance_band().alias("trip_distance_bucket"))


@register("p9_airport_flag", with_ctes(
    "SELECT trip_key, (coalesce(airport_fee, 0) > 0) OR (rate_code_id = 2) AS is_airport_trip FROM renamed",
    "renamed"))
def q_p9(spark, d):
    return renamed(spark, d).select("trip_key", C.airport_flag().alias("is_airport_trip"))


@register("p9b_airport_flag_01", with_ctes(
    "SELECT trip_key, CAST(coalesce((coalesce(Airport_fee, 0) > 0) OR (RatecodeID = 2), false) AS INTEGER) "
    "AS is_airport_trip FROM trips", "trips"))
def q_p9b(spark, d):
    return trips(spark, d).select("trip_key", C.airport_flag_01().alias("is_airport_trip"))


@register("p10_high_tip", with_ctes(
    "SELECT trip_key, tip_pct, CAST(tip_pct > 20 AS INTEGER) AS high_tip FROM enriched", "enriched"))
def q_p10(spark, d):
    return P.add_ml_label(enriched(spark, d)).select("trip_key", "tip_pct", "high_tip")


@register("p10b_high_tip_01", with_ctes(
    "SELECT trip_key, tip_pct, coalesce(CAST(tip_pct > 20 AS INTEGER), 0) AS high_tip FROM enriched", "enriched"))
def q_p10b(spark, d):
    return enriched(spark, d).select("trip_key", "tip_pct", C.high_tip_01().alias("high_tip"))


@register("p11_drop_fields", with_ctes(
    "SELECT * EXCLUDE (store_and_fwd_flag, mta_tax, improvement_surcharge) FROM trips", "trips"))
def q_p11(spark, d):
    return CL.drop_fields(trips(spark, d))


@register("p12_drop_leaking_columns", with_ctes(
    "SELECT * EXCLUDE (payment_label, tip_pct), coalesce(CAST(tip_pct > 20 AS INTEGER), 0) AS high_tip "
    "FROM enriched WHERE payment_label = 'Credit card'", "enriched"))
def q_p12(spark, d):
    df = CL.card_payments(enriched(spark, d)).withColumn("high_tip", C.high_tip_01())
    return CL.drop_fields(df, ["payment_label", "tip_pct"])


@register("p13_label_first", with_ctes(
    "SELECT CAST(tip_pct > 20 AS INTEGER) AS high_tip, * FROM enriched", "enriched"))
def q_p13(spark, d):
    return CL.label_first(P.add_ml_label(enriched(spark, d)), "high_tip")


# Column and expected feature name of dataset A.
_A_FEATURE_NAMES = [
    ("high_tip", "high_tip"), ("trip_distance", "trip_distance"), ("trip_duration_min", "trip_duration_min"),
    ("trip_speed_mph", "trip_speed_mph"), ("pickup_hour", "pickup_hour"), ("passenger_count", "passenger_count"),
    ("fare_amount", "fare_amount"), ("is_airport_trip", "is_airport_trip"),
    ("trip_distance_bucket_medium", "trip_distance_bucket_medium"),
    ("trip_distance_bucket_short", "trip_distance_bucket_short"),
    ("trip_distance_bucket_very_long", "trip_distance_bucket_very_long"),
    ("pickup_borough_AMERICA", "pickup_borough_AMERICA"), ("pickup_borough_ASIA", "pickup_borough_ASIA"),
    ("pickup_borough_EUROPE", "pickup_borough_EUROPE"),
    ("pickup_borough_MIDDLE EAST", "pickup_borough_MIDDLE_EAST"), ("pickup_borough_N/A", "pickup_borough_N_A"),
]


@register("p14_sanitize_names", with_ctes(
    "SELECT " + ", ".join(
        f"\"{c}\" AS \"{s}\"" for c, s in [("trip_key", "trip_key"), ("split", "split"), *_A_FEATURE_NAMES])
    + " FROM ds_a", "ds_a"))
def q_p14(spark, d):
    return CL.sanitize_columns(dataset_a(spark, d))


@register("p15_booleans_to_int", with_ctes(
    "SELECT * REPLACE (CAST(is_airport_trip AS INTEGER) AS is_airport_trip) FROM enriched", "enriched"))
def q_p15(spark, d):
    return CL.booleans_to_int(enriched(spark, d))


@register("p16_record_id", with_ctes("SELECT trip_key, md5(trip_key) AS trip_id FROM trips", "trips"))
def q_p16(spark, d):
    return FS.with_record_id(trips(spark, d).select("trip_key"), ["trip_key"])


LOAD_TS = 1704067200.0  # event time stamped on the feature-group load (caller-chosen constant)


@register("p17_event_time", with_ctes(
    f"SELECT trip_key, CAST({LOAD_TS!r} AS DOUBLE) AS event_time FROM trips", "trips"))
def q_p17(spark, d):
    return FS.with_event_time(trips(spark, d).select("trip_key"), LOAD_TS)


@register("p18_derived_formula", with_ctes(
    "SELECT trip_key, CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END AS fare_per_mile "
    "FROM enriched", "enriched"))
def q_p18(spark, d):
    return enriched(spark, d).select(
        "trip_key", F.expr("CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END").alias("fare_per_mile"))


# ------------------------------------------------------------------ filters F1-F8

@register("f1_drop_missing", with_ctes("SELECT * FROM f1", "f1"))
def q_f1(spark, d):
    return f1(spark, d)


@register("f2_duration_range", with_ctes("SELECT * FROM f2", "f2"))
def q_f2(spark, d):
    return f2(spark, d)


@register("f3_distance_range", with_ctes("SELECT * FROM f3", "f3"))
def q_f3(spark, d):
    return CL.distance_range(f2(spark, d))


@register("f4_revenue_trips", with_ctes("SELECT * FROM f4", "f4"))
def q_f4(spark, d):
    return f4(spark, d)


@register("f5_plausible_speed", with_ctes("SELECT * FROM f5", "f5"))
def q_f5(spark, d):
    return P.clean_trips(trips(spark, d))


@register("f6_card_by_label", with_ctes("SELECT * FROM enriched WHERE payment_label = 'Credit card'", "enriched"))
def q_f6(spark, d):
    return CL.card_payments(enriched(spark, d), by="label")


@register("f6b_card_by_code", with_ctes("SELECT * FROM trips WHERE payment_type = 1", "trips"))
def q_f6b(spark, d):
    return CL.card_payments(trips(spark, d), by="code")


@register("f7_complete_cases", with_ctes(
    "SELECT * FROM enriched WHERE " + " AND ".join(
        f"{c} IS NOT NULL" for c in [*P.ENRICHED_COLUMNS, "trip_key"]), "enriched"))
def q_f7(spark, d):
    return CL.complete_cases(enriched(spark, d))


@register("f8_name_contains", with_ctes(
    "SELECT trip_key, pickup_zone FROM enriched WHERE contains(pickup_zone, 'NATION_1')", "enriched"))
def q_f8(spark, d):
    return CL.name_contains(enriched(spark, d).select("trip_key", "pickup_zone"), "pickup_zone", "NATION_1")


# ------------------------------------------------------------------ joins J1-J3

@register("j1_pickup_zone_join", with_ctes(
    "SELECT t.trip_key, t.pu_location_id, z.Borough AS pickup_borough, z.Zone AS pickup_zone "
    "FROM renamed t LEFT JOIN zones z ON t.pu_location_id = z.LocationID", "renamed", "zones"))
def q_j1(spark, d):
    z = J.role_projection(zones(spark, d), "pu_location_id", "pickup")
    dim, _ = J.checked_broadcast(z, "pu_location_id")
    return renamed(spark, d).select("trip_key", "pu_location_id").join(dim, "pu_location_id", "left")


@register("j2_dropoff_zone_join", with_ctes(
    "SELECT t.trip_key, t.do_location_id, z.Borough AS dropoff_borough, z.Zone AS dropoff_zone "
    "FROM renamed t LEFT JOIN zones z ON t.do_location_id = z.LocationID", "renamed", "zones"))
def q_j2(spark, d):
    z = J.role_projection(zones(spark, d), "do_location_id", "dropoff")
    dim, _ = J.checked_broadcast(z, "do_location_id")
    return renamed(spark, d).select("trip_key", "do_location_id").join(dim, "do_location_id", "left")


@register("j3_attach_labels", """
    SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_j3(spark, d):
    docs = X.table(spark, d, "documents").select("doc_id", "lang")
    return J.attach_labels(docs, X.table(spark, d, "labels"), "doc_id")


# ------------------------------------------------------------------ aggregates A1-A12

@register("a1_row_count", with_ctes("SELECT count(*) AS rows FROM enriched", "enriched"))
def q_a1(spark, d):
    return A.row_count(enriched(spark, d))


@register("a3_positive_rate", with_ctes(
    "SELECT round(avg(CAST(high_tip AS DOUBLE)), 10) AS positive_rate, count(*) AS rows FROM ds_a", "ds_a"))
def q_a3(spark, d):
    return _round_doubles(A.positive_rate(dataset_a(spark, d), "high_tip"))


@register("a4_drop_duplicates", with_ctes("SELECT DISTINCT * FROM trips_dup", "trips_dup"))
def q_a4(spark, d):
    return A.drop_duplicates(X.trips_dup(spark, d))


@register("a5_accuracy", with_ctes(
    "SELECT round(avg(CAST((CAST(score >= 0.5 AS INTEGER) = high_tip) AS DOUBLE)), 10) AS accuracy, "
    "count(*) AS rows FROM ds_b_test", "ds_b_test"))
def q_a5(spark, d):
    return _round_doubles(A.accuracy(scored_test(spark, d), "high_tip"))


_AUC_SQL = """
    SELECT round(sum(pos * (coalesce(neg_below, 0) + neg / 2.0)) / (sum(pos) * sum(neg)), 10) AS auc,
           round(sum(CASE WHEN s >= 0.5 THEN pos ELSE neg END) / sum(pos + neg), 10) AS accuracy,
           CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
           (SELECT count(*) FROM ds_b_test WHERE score IS NULL OR isnan(score) OR high_tip IS NULL) AS excluded
    FROM (SELECT s, pos, neg, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS neg_below
          FROM (SELECT score AS s, CAST(sum(CASE WHEN high_tip = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
                       CAST(sum(CASE WHEN high_tip = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS neg
                FROM ds_b_test GROUP BY score))"""


@register("a6_auc", with_ctes(_AUC_SQL, "ds_b_test"))
def q_a6(spark, d):
    return _round_doubles(A.auc(scored_test(spark, d), "high_tip"))


@register("a7_profile", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null, CAST(count(*) - count({c}) AS BIGINT) AS nulls, "
    f"count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS min_value, "
    f"CAST(max({c}) AS VARCHAR) AS max_value FROM trips" for c in X.RAW_TRIP_COLUMNS), "trips"))
def q_a7(spark, d):
    return A.profile(trips(spark, d).select(*X.RAW_TRIP_COLUMNS), exact_distinct=True)


@register("a11_split_counts", with_ctes("SELECT split, count(*) AS rows FROM ds_b GROUP BY split", "ds_b"))
def q_a11(spark, d):
    return A.split_counts(dataset_b(spark, d))


@register("a12_distinct_categories", with_ctes("""
    SELECT DISTINCT 'trip_distance_bucket' AS column_name, trip_distance_bucket AS value FROM enriched
    UNION ALL SELECT DISTINCT 'pickup_borough', pickup_borough FROM enriched WHERE pickup_borough IS NOT NULL""",
    "enriched"))
def q_a12(spark, d):
    found = A.distinct_categories(enriched(spark, d), M.CATEGORICAL)
    return spark.createDataFrame([(c, v) for c, values in found.items() for v in values],
                                 "column_name string, value string")


# ------------------------------------------------------------------ sampling / limits L2, L5, L6

@register("l2_first_n_by_key", with_ctes(
    f"SELECT * FROM ds_a WHERE split = 'train' {sample_qualify(2000, seed=0)}", "ds_a"))
def q_l2(spark, d):
    train = dataset_a(spark, d).where(F.col("split") == "train")
    return S.take_by_hash(train, 2000, ["trip_key"], seed=0)


@register("l5_exact_sample", with_ctes(f"SELECT * FROM ds_b_cc {sample_qualify(1000)}", "ds_b_cc"))
def q_l5(spark, d):
    return S.take_by_hash(M.fixed_feature_rows(trips(spark, d)), 1000, ["trip_key"], seed=42)


@register("l6_bernoulli_sample")
def q_l6(spark, d):
    return S.approx_sample(enriched(spark, d), 0.1, seed=42)


SPLITS = ("train", "validation", "test")


# ------------------------------------------------------------------ set operations U1-U3

@register("u2_append_frames", with_ctes(
    "SELECT 'train' AS split, count(*) AS rows FROM ds_b WHERE split = 'train' "
    "UNION ALL SELECT 'validation', count(*) FROM ds_b WHERE split = 'validation' "
    "UNION ALL SELECT 'test', count(*) FROM ds_b WHERE split = 'test'", "ds_b"))
def q_u2(spark, d):
    ds = dataset_b(spark, d)
    parts = [ds.where(F.col("split") == s).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(s).alias("split"), "rows")
             for s in SPLITS]
    return U.append_all(parts)


@register("u3_frame_difference", with_ctes("""
    SELECT *, 'left_only' AS side FROM (
        SELECT * FROM trips_dup WHERE DOLocationID IS DISTINCT FROM 2
        EXCEPT ALL SELECT * FROM trips WHERE PULocationID IS DISTINCT FROM 7)
    UNION ALL
    SELECT *, 'right_only' FROM (
        SELECT * FROM trips WHERE PULocationID IS DISTINCT FROM 7
        EXCEPT ALL SELECT * FROM trips_dup WHERE DOLocationID IS DISTINCT FROM 2)""",
    "trips", "trips_dup"))
def q_u3(spark, d):
    """Rows copied on one side (pickup 3) and rows missing on either side, with their multiplicity."""
    left = X.trips_dup(spark, d).where(~F.col("DOLocationID").eqNullSafe(2))
    return U.frame_difference(left, trips(spark, d).where(~F.col("PULocationID").eqNullSafe(7)))


# ------------------------------------------------------------------ sources / sinks

def _materialize_trips(spark, d) -> str:
    """Raw trips as Parquet files in one folder per vendor (the shape of a raw landing zone), in one pass."""
    base = scratch_path(spark, "raw_trips")
    trips(spark, d).withColumn("vendor", F.col("VendorID")).write.partitionBy("vendor").parquet(base)
    return base


@register("s1_scan_parquet_recursive", with_ctes("SELECT * FROM trips", "trips"))
def q_s1(spark, d):
    base = _materialize_trips(spark, d)
    return RD.read_parquet(spark, base, recursive=True).select(*X.RAW_TRIP_COLUMNS)


# The columns the preprocessing step reads.
_PRE_COLS = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "passenger_count", "fare_amount",
             "tip_amount", "payment_type", "RatecodeID", "Airport_fee"]


@register("s2_u1_scan_many_projected", with_ctes(f"SELECT {', '.join(_PRE_COLS)} FROM trips", "trips"))
def q_s2(spark, d):
    base = _materialize_trips(spark, d)
    return RD.read_parquet(spark, f"{base}/vendor=*", columns=_PRE_COLS)


@register("s3_k7_csv_roundtrip_infer", with_ctes("SELECT * FROM zones", "zones"))
def q_s3(spark, d):
    path = WR.write_csv(zones(spark, d), scratch_path(spark, "zones_csv"), header=True)
    return RD.read_csv(spark, path, header=True, infer=True)


@register("k1_s4_partitioned_roundtrip", with_ctes(
    "SELECT trip_distance, trip_duration_min, trip_speed_mph, pickup_hour, passenger_count, fare_amount, "
    "trip_distance_bucket, pickup_borough, is_airport_trip, payment_label, tip_pct, pickup_date "
    "FROM enriched WHERE payment_label = 'Credit card'", "enriched"))
def q_k1(spark, d):
    path = scratch_path(spark, "enriched_by_date")
    WR.write_partitioned(P.build_pipeline(trips(spark, d), zones(spark, d)), path, "pickup_date")
    cols = [*M.NUMERIC, *M.CATEGORICAL, *M.BOOL, "payment_label", "tip_pct", "pickup_date"]
    return RD.read_partitioned(spark, path, cols, F.col("payment_label") == C.CARD_LABEL)


_B_SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in ["high_tip", *B_FEATURES]])


@register("k3_s7_splits_with_header", with_ctes(
    "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ["high_tip", *B_FEATURES])
    + ", split FROM ds_b", "ds_b"))
def q_k3(spark, d):
    path = scratch_path(spark, "splits_header")
    WR.write_splits(dataset_b(spark, d).drop("trip_key"), path, header=True)
    return U.append_all([RD.read_channel(spark, f"{path}/split={s}").withColumn("split", F.lit(s)) for s in SPLITS])


_A_COLS = ["high_tip", "trip_distance", "trip_duration_min", "trip_speed_mph", "pickup_hour", "passenger_count",
           "fare_amount", "is_airport_trip", *A_DUMMY_NAMES]


@register("s5_csv_header_explicit_schema", with_ctes(
    "SELECT " + ", ".join(f"\"{c}\"" for c in _A_COLS) + ", split FROM ds_a", "ds_a"))
def q_s5(spark, d):
    path = scratch_path(spark, "dataset_a_csv")
    ds = dataset_a(spark, d).drop("trip_key")
    WR.write_splits(ds, path, header=True)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in ds.drop("split").schema.fields])
    return U.append_all([RD.read_csv(spark, f"{path}/split={s}", header=True, schema=schema).withColumn("split", F.lit(s))
                         for s in SPLITS])


@register("k4_s6_s7_splits_headerless", with_ctes(
    "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS _c{i}" for i, c in enumerate(["high_tip", *B_FEATURES]))
    + ", split FROM ds_b", "ds_b"))
def q_k4(spark, d):
    path = scratch_path(spark, "splits_noheader")
    WR.write_splits(dataset_b(spark, d).drop("trip_key"), path, header=False)
    return U.append_all([RD.read_channel(spark, f"{path}/split={s}").withColumn("split", F.lit(s)) for s in SPLITS])


@register("s6_csv_positional_schema", with_ctes(
    "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ["high_tip", *B_FEATURES])
    + " FROM ds_b WHERE split = 'test'", "ds_b"))
def q_s6(spark, d):
    path = scratch_path(spark, "test_noheader")
    WR.write_csv(M.split_of(dataset_b(spark, d), "test").drop("trip_key"), path, header=False)
    return RD.read_csv(spark, path, header=False, schema=_B_SCHEMA)


@register("k7_s3_visual_flow_csv", with_ctes(
    "SELECT * EXCLUDE (store_and_fwd_flag, mta_tax, improvement_surcharge) FROM (SELECT DISTINCT * FROM trips_dup)",
    "trips_dup"))
def q_k7(spark, d):
    """The flow's last node written as CSV (gzip parts) and read back with inference (times without zone)."""
    path = WR.write_csv(M.visual_flow(X.trips_dup(spark, d)), scratch_path(spark, "visual_flow_csv"), compression="gzip")
    back = RD.read_csv(spark, path, header=True, infer=True)
    return back.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in back.dtypes])


@register("s12b_first_rows_in_file_order", "SELECT event_id, event_type, event_id - (SELECT min(event_id) FROM events) AS position "
          "FROM events ORDER BY event_id LIMIT 300")
def q_s12b(spark, d):
    """The first rows as the files hold them (events are stored in order of their ids)."""
    return PO.first_rows(PO.read_positions(spark, f"{d.rstrip('/')}/events.parquet", ["event_id", "event_type"]), 300)


@register("m2b_split_by_position", with_ctes("""
    SELECT trip_key, position, CASE WHEN position < floor(CAST(0.70 AS DOUBLE) * n) THEN 'train' WHEN position < floor(CAST(0.85 AS DOUBLE) * n) THEN 'validation'
                               ELSE 'test' END AS split
    FROM (SELECT trip_key, row_number() OVER (ORDER BY trip_key) - 1 AS position, count(*) OVER () AS n FROM ds_b)""", "ds_b"))
def q_m2b(spark, d):
    """70/15/15 by position with exact sizes, over the rows that are left after the filters."""
    return PO.split_by_position(PO.dense_positions(dataset_b(spark, d).select("trip_key"), "trip_key"))


@register("m7_validate_runs", """
    SELECT l_orderkey, l_linenumber, learning_rate, n_estimators, max_depth, outside = '' AS accepted, outside FROM (
        SELECT *, concat_ws(',', CASE WHEN NOT learning_rate BETWEEN 0.0001 AND 1 THEN 'learning_rate' END,
                            CASE WHEN NOT n_estimators BETWEEN 1 AND 1000 THEN 'n_estimators' END,
                            CASE WHEN NOT max_depth BETWEEN 1 AND 20 THEN 'max_depth' END) AS outside
        FROM (SELECT l_orderkey, l_linenumber, l_discount AS learning_rate, CAST(l_quantity * 25 AS INTEGER) AS n_estimators,
                     l_linenumber * 4 AS max_depth FROM lineitem))""")
def q_m7(spark, d):
    """A table of runs (one per line item, its numbers as hyperparameters) with those outside the accepted ranges named."""
    rows = X.table(spark, d, "lineitem")
    return L.validate_runs(rows.select(
        "l_orderkey", "l_linenumber", F.col("l_discount").alias("learning_rate"),
        (F.col("l_quantity") * 25).cast("int").alias("n_estimators"), (F.col("l_linenumber") * 4).alias("max_depth")))


@register("s8_infer_and_cast", "SELECT * FROM events")
def q_s8(spark, d):
    ev = X.table(spark, d, "events")
    path = scratch_path(spark, "events_text_csv")
    ev.select(*[F.col(c).cast("string").alias(c) for c in ev.columns]).write.option("header", "true") \
        .option("escape", '"').csv(path)
    raw = spark.read.option("header", "true").option("escape", '"').csv(path)
    return RD.infer_and_cast(raw)


@register("k2_m21_visual_flow", with_ctes(
    "SELECT * EXCLUDE (store_and_fwd_flag, mta_tax, improvement_surcharge) FROM (SELECT DISTINCT * FROM trips_dup)",
    "trips_dup"))
def q_m21(spark, d):
    path = WR.write_parquet(M.visual_flow(X.trips_dup(spark, d)), scratch_path(spark, "visual_flow"))
    return RD.read_parquet(spark, path)


@register("s11_catalog_sql", with_ctes("""
    SELECT e.dropoff_borough, z.zones_in_borough, count(*) AS trips
    FROM enriched e LEFT JOIN (SELECT Borough, count(*) AS zones_in_borough FROM zones GROUP BY Borough) z
      ON e.dropoff_borough = z.Borough
    GROUP BY e.dropoff_borough, z.zones_in_borough""", "enriched", "zones"))
def q_s11(spark, d):
    RD.register_tables(spark, {"fb_enriched": enriched(spark, d), "fb_zones": zones(spark, d)})
    return spark.sql("""
        SELECT e.dropoff_borough, z.zones_in_borough, count(*) AS trips
        FROM fb_enriched e LEFT JOIN (SELECT Borough, count(*) AS zones_in_borough FROM fb_zones GROUP BY Borough) z
          ON e.dropoff_borough = z.Borough
        GROUP BY e.dropoff_borough, z.zones_in_borough""")


@register("s12_first_rows_of_split", with_ctes(
    f"SELECT * EXCLUDE (split) FROM ds_b WHERE split = 'test' {sample_qualify(300, seed=0)}", "ds_b"))
def q_s12(spark, d):
    return S.take_by_hash(M.split_of(dataset_b(spark, d), "test"), 300, ["trip_key"], seed=0)


@register("s10_k9_j3_manifest_roundtrip", """
    SELECT 'documents/' || CAST(d.doc_id AS VARCHAR) || '.txt' AS "source-ref", l.quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_s10(spark, d):
    docs = X.table(spark, d, "documents")
    ref = F.concat(F.lit("documents/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    path = LB.write_manifest(docs, ref, scratch_path(spark, "manifest"))
    manifest = LB.read_manifest(spark, path)
    labels = X.table(spark, d, "labels").select(
        F.concat(F.lit("documents/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias(LB.SOURCE_REF), "quality")
    aug_path = LB.write_augmented(LB.augment(manifest, labels, "quality"), "quality", scratch_path(spark, "augmented"))
    return LB.read_manifest(spark, aug_path, "quality")


# ------------------------------------------------------------------ dataset builders M1-M3b

@register("m1_one_hot_drop_first", with_ctes(
    "SELECT trip_key, " + ", ".join(
        f"CASE WHEN {col} = '{v}' THEN 1 ELSE 0 END AS \"{col}_{v}\""
        for col, vals in [("trip_distance_bucket", ["medium", "short", "very_long"]),
                          ("pickup_borough", ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "N/A"])] for v in vals)
    + " FROM enriched", "enriched"))
def q_m1(spark, d):
    return one_hot(enriched(spark, d).select("trip_key", *M.CATEGORICAL), M.CATEGORICAL)


@register("m2_hash_split", with_ctes(f"SELECT trip_key, {split_sql()} AS split FROM trips", "trips"))
def q_m2(spark, d):
    return S.with_split(trips(spark, d).select("trip_key"), "trip_key")


@register("m3_dataset_one_hot", with_ctes("SELECT * FROM ds_a", "ds_a"))
def q_m3(spark, d):
    return dataset_a(spark, d)


@register("m3b_dataset_fixed_features", with_ctes("SELECT * FROM ds_b", "ds_b"))
def q_m3b(spark, d):
    return dataset_b(spark, d)


# ------------------------------------------------------------------ feature tables M5, M6

def _feature_rows(spark, d):
    train = M.split_of(dataset_a(spark, d), "train")
    rows = CL.sanitize_columns(FS.with_record_id(train, ["trip_key"]).drop("trip_key"))
    return FS.with_event_time(rows, LOAD_TS)


@register("m5_k8_feature_group_ingest", with_ctes(
    "SELECT md5(trip_key) AS trip_id, " + ", ".join(
        f"\"{c}\" AS \"{s}\"" for c, s in _A_FEATURE_NAMES)
    + f", CAST({LOAD_TS!r} AS DOUBLE) AS event_time, CAST(to_timestamp({LOAD_TS!r}) AS DATE) AS event_date "
      "FROM ds_a WHERE split = 'train'", "ds_a"))
def q_m5(spark, d):
    path = FS.ingest(_feature_rows(spark, d), scratch_path(spark, "feature_store"))
    return spark.read.option("basePath", path).parquet(path)


@register("m6_latest_record_per_id", """
    SELECT * FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id
                               ORDER BY ts DESC, event_id DESC, event_type DESC, value DESC, props DESC) = 1""")
def q_m6(spark, d):
    return FS.latest_records(X.table(spark, d, "events"), "user_id", "ts")


# ------------------------------------------------------------------ evaluation, gate, bias, SHAP (fixed scorer)

def _report(spark, d):
    return MF.evaluate(scored_test(spark, d))


@register("m10_k6_s9_evaluation_report", with_ctes(
    "SELECT auc, accuracy FROM (" + _AUC_SQL + ")", "ds_b_test"))
def q_m10(spark, d):
    path = WR.write_json_lines(_report(spark, d), "report", scratch_path(spark, "evaluation"))
    rep = RD.read_json_report(spark, path)
    return rep.select(
        F.round(RD.json_value(F.col("report"), "binary_classification_metrics.auc.value").cast("double"),
                METRIC_DIGITS).alias("auc"),
        F.round(RD.json_value(F.col("report"), "binary_classification_metrics.accuracy.value").cast("double"),
                METRIC_DIGITS).alias("accuracy"))


@register("m11_metrics_from_log", with_ctes(
    "SELECT 'validation:auc' AS metric_name, round(auc, 4) AS value FROM (" + _AUC_SQL + ") "
    "UNION ALL SELECT 'validation:accuracy', round(accuracy, 4) FROM (" + _AUC_SQL + ")", "ds_b_test"))
def q_m11(spark, d):
    rep = _report(spark, d)
    lines = R.metric_lines(rep, {"accuracy": "validation_accuracy", "auc": "validation_auc"})
    path = scratch_path(spark, "train_log")
    lines.write.mode("overwrite").text(path)
    return R.metrics_from_log(spark.read.text(path))


@register("m14_quality_gate", with_ctes(
    "SELECT round(auc, 10) AS auc, round(accuracy, 10) AS accuracy, 'Approved' AS approval_status, "
    "'taxi-models' AS model_package_group FROM (" + _AUC_SQL + ") WHERE auc >= 0.55", "ds_b_test"))
def q_m14(spark, d):
    versions = R.append_rows(MF.gate(_report(spark, d), "taxi-models"), scratch_path(spark, "model_versions"))
    return versions.select(F.round("auc", METRIC_DIGITS).alias("auc"),
                           F.round("accuracy", METRIC_DIGITS).alias("accuracy"),
                           "approval_status", "model_package_group")


def _bias_sql(src: str, facet: str, label: str, post: bool) -> str:
    pred = "CAST(score >= 0.5 AS INTEGER)"
    counts = [f"count(*) AS n_d", f"sum(CASE WHEN {label} = 1 THEN 1 ELSE 0 END) AS pos_d"]
    if post:
        counts += [f"sum({pred}) AS pred_pos_d",
                   f"sum(CASE WHEN {label} = 1 AND {pred} = 1 THEN 1 ELSE 0 END) AS tp_d",
                   f"sum(CASE WHEN {label} <> 1 AND {pred} = 1 THEN 1 ELSE 0 END) AS fp_d",
                   f"sum(CASE WHEN {label} = 1 AND {pred} = 0 THEN 1 ELSE 0 END) AS fn_d",
                   f"sum(CASE WHEN {label} <> 1 AND {pred} = 0 THEN 1 ELSE 0 END) AS tn_d"]
    names = ["n", "pos"] + (["pred_pos", "tp", "fp", "fn", "tn"] if post else [])
    rest = ", ".join(f"CAST(sum({k}_d) OVER () - {k}_d AS DOUBLE) AS {k}_a, CAST({k}_d AS DOUBLE) AS {k}_dd"
                     for k in names)
    base = (f"SELECT facet_value, CAST(n_d AS BIGINT) AS n_d, {rest} FROM "
            f"(SELECT {facet} AS facet_value, {', '.join(counts)} FROM {src} GROUP BY {facet})")

    def r(a, b):
        return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END)"

    if not post:
        qd, qa = r("pos_dd", "n_dd"), r("pos_a", "n_a")

        def kl(p, q):
            return f"(CASE WHEN ({p}) = 0 THEN 0.0 WHEN ({q}) = 0 THEN NULL ELSE ({p}) * ln(({p}) / ({q})) END)"
        md, mp = f"((1 - {qa} + 1 - {qd}) / 2)", f"(({qa} + {qd}) / 2)"
        diff = f"abs({qa} - {qd})"
        metrics = {
            "CI": r("n_a - n_dd", "n_a + n_dd"), "DPL": f"({qa} - {qd})",
            "KL": f"({kl('1 - ' + qa, '1 - ' + qd)} + {kl(qa, qd)})",
            "JS": f"(({kl('1 - ' + qa, md)} + {kl(qa, mp)} + {kl('1 - ' + qd, md)} + {kl(qd, mp)}) / 2)",
            "LP": f"sqrt(2.0 * {diff} * {diff})", "TVD": diff, "KS": diff}
    else:
        def rt(a, b, s):
            return r(a.replace("#", s), b.replace("#", s))
        n = "(n_dd + n_a)"
        tp, tn, fp = "(tp_dd + tp_a)", "(tn_dd + tn_a)", "(fp_dd + fp_a)"
        bmean = r(f"({tp} + {tn} + 2 * {fp})", n)
        metrics = {
            "DPPL": f"({rt('pred_pos_#', 'n_#', 'a')} - {rt('pred_pos_#', 'n_#', 'dd')})",
            "DI": r(rt("pred_pos_#", "n_#", "dd"), rt("pred_pos_#", "n_#", "a")),
            "DCA": f"({rt('pos_#', 'pred_pos_#', 'a')} - {rt('pos_#', 'pred_pos_#', 'dd')})",
            "DCR": f"({rt('n_# - pos_#', 'n_# - pred_pos_#', 'dd')} - {rt('n_# - pos_#', 'n_# - pred_pos_#', 'a')})",
            "RD": f"({rt('tp_#', 'tp_# + fn_#', 'a')} - {rt('tp_#', 'tp_# + fn_#', 'dd')})",
            "AD": f"({rt('tp_# + tn_#', 'n_#', 'a')} - {rt('tp_# + tn_#', 'n_#', 'dd')})",
            "DAR": f"({rt('tp_#', 'tp_# + fp_#', 'a')} - {rt('tp_#', 'tp_# + fp_#', 'dd')})",
            "DRR": f"({rt('tn_#', 'tn_# + fn_#', 'dd')} - {rt('tn_#', 'tn_# + fn_#', 'a')})",
            "SD": f"({rt('tn_#', 'tn_# + fp_#', 'dd')} - {rt('tn_#', 'tn_# + fp_#', 'a')})",
            "TE": f"({rt('fn_#', 'fp_#', 'dd')} - {rt('fn_#', 'fp_#', 'a')})",
            "GE": r(f"{r(f'({tp} + {tn} + 4 * {fp})', f'{bmean} * {bmean}')} - {n}", f"2 * {n}"),
        }
    sel = ", ".join(f"round({e}, {METRIC_DIGITS}) AS {k}" for k, e in metrics.items())
    return f"SELECT facet_value, n_d, CAST(n_a AS BIGINT) AS n_a, {sel} FROM ({base})"


@register("m15_pre_training_bias", with_ctes(_bias_sql("ds_b_train", "is_airport_trip", "high_tip", False),
                                             "ds_b_train"))
def q_m15(spark, d):
    return _round_doubles(MF.data_bias(M.split_of(dataset_b(spark, d), "train")))


@register("m15b_pre_training_bias_documents", _bias_sql(
    "(SELECT d.lang, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)", "lang", "quality", False))
def q_m15b(spark, d):
    docs = J.attach_labels(X.table(spark, d, "documents").select("doc_id", "lang"),
                           X.table(spark, d, "labels"), "doc_id").where(F.col("quality").isNotNull())
    return _round_doubles(B.pre_training_bias(docs, "lang", "quality"))


@register("m16_post_training_bias", with_ctes(_bias_sql("ds_b_test", "is_airport_trip", "high_tip", True),
                                              "ds_b_test"))
def q_m16(spark, d):
    return _round_doubles(MF.model_bias(scored_test(spark, d)))


@register("m18_bias_baseline", with_ctes(
    "SELECT facet_value, metric, value, 'DataBiasCheck' AS check_name, 1 AS baseline_version FROM ("
    "SELECT * FROM (" + _bias_sql("ds_b_train", "is_airport_trip", "high_tip", False)
    + ") UNPIVOT INCLUDE NULLS (value FOR metric IN (CI, DPL, KL, JS, LP, TVD, KS)))", "ds_b_train"))
def q_m18(spark, d):
    metrics = MF.data_bias(M.split_of(dataset_b(spark, d), "train"))
    long = _round_doubles(B.to_long(metrics, B.PRE_METRICS))
    return R.append_rows(R.baseline_rows(long, "DataBiasCheck"), scratch_path(spark, "bias_baselines"))


def _shap_sql(src: str, baseline: list[float] | None, per_row: bool = False, digits: int = METRIC_DIGITS,
              score: str | None = None) -> str:
    """Exact Shapley values of the fixed scorer (or of ``score``) in DuckDB: every row against every coalition.

    ``baseline=None`` uses the feature means of ``src`` (scalar subqueries).
    """
    p = len(B_FEATURES)
    base = [f"CAST({baseline[i]!r} AS DOUBLE)" if baseline is not None else f"(SELECT avg(CAST({c} AS DOUBLE)) FROM {src})"
            for i, c in enumerate(B_FEATURES)]
    mixed = [f"CASE WHEN (g.m >> {i}) & 1 = 1 THEN CAST(g.{c} AS DOUBLE) ELSE {base[i]} END AS {c}"
             for i, c in enumerate(B_FEATURES)]
    coef = [f"CASE WHEN (g.m >> {i}) & 1 = 1 THEN w_in ELSE -w_out END AS c{i}" for i in range(p)]
    head = f"""
    WITH co AS (
      SELECT m, CAST(factorial(CAST(greatest(k - 1, 0) AS INTEGER)) * factorial(CAST({p} - k AS INTEGER)) AS DOUBLE)
                / CAST(factorial({p}) AS DOUBLE) AS w_in,
             CAST(factorial(CAST(k AS INTEGER)) * factorial(CAST(greatest({p} - k - 1, 0) AS INTEGER)) AS DOUBLE)
                / CAST(factorial({p}) AS DOUBLE) AS w_out
      FROM (SELECT range AS m, bit_count(range) AS k FROM range(0, {2 ** p}))),
    gen AS (SELECT *, unnest(range(0, {2 ** p})) AS m FROM {src}),
    ex AS (SELECT g.trip_key, g.m, {', '.join(mixed)}, {', '.join(coef)}
           FROM gen g JOIN co ON g.m = co.m),
    sc AS (SELECT *, {score or fixed_score_sql()} AS f FROM ex),
    phi AS (SELECT trip_key, {', '.join(f'sum(c{i} * f) AS phi{i}' for i in range(p))} FROM sc GROUP BY trip_key)"""
    if per_row:
        cols = ", ".join(f"round(phi{i}, {digits}) + 0.0 AS phi_{c}" for i, c in enumerate(B_FEATURES))
        return f"{head}\n    SELECT trip_key, {cols} FROM phi"
    return f"""{head}
    SELECT feature, round(mean_abs, {digits}) AS mean_abs FROM (
      {' UNION ALL '.join(f"SELECT '{c}' AS feature, avg(abs(phi{i})) AS mean_abs FROM phi"
                          for i, c in enumerate(B_FEATURES))})"""


@register("m17_a8_shap_mean_abs", with_ctes(_shap_sql("ds_b_test", MF.SHAP_BASELINE), "ds_b_test"))
def q_m17(spark, d):
    test = M.split_of(dataset_b(spark, d), "test")
    phis = MF.explain_fixed(test)
    return _round_doubles(EX.mean_abs(phis, M.FIXED_FEATURES))


PER_ROW_DIGITS = 9


@register("m17c_shap_per_row", with_ctes(
    _shap_sql("ds_b_test", MF.SHAP_BASELINE, per_row=True, digits=PER_ROW_DIGITS), "ds_b_test"))
def q_m17c(spark, d):
    test = M.split_of(dataset_b(spark, d), "test")
    phis = MF.explain_fixed(test).select("trip_key", *[f"phi_{c}" for c in M.FIXED_FEATURES])
    return _round_doubles(phis, PER_ROW_DIGITS, unsigned_zero=True)


@register("m17d_shap_mean_abs_mean_baseline", with_ctes(_shap_sql("ds_b_test", None), "ds_b_test"))
def q_m17d(spark, d):
    """No baseline given (the reference's stand-alone explainability run): baseline = feature means."""
    test = M.split_of(dataset_b(spark, d), "test")
    phis = MF.explain_fixed(test, baseline=None)
    return _round_doubles(EX.mean_abs(phis, M.FIXED_FEATURES))


_A_FEATURES = [*B_FEATURES, *A_DUMMY_NAMES]
# Our own fixed weights for the attributions of dataset A (one per feature, in order).
_A_WEIGHTS = [round(0.1 * (-1) ** i / (i + 1), 4) for i in range(len(_A_FEATURES))]


def _linear_score(xs):
    return sum((F.lit(w) * x.cast("double") for w, x in zip(_A_WEIGHTS, xs)), F.lit(0.0))


@register("m17e_kernel_shap_linear_dataset_a", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg(abs({w!r} * (\"{c}\" - (SELECT avg(\"{c}\") FROM ds_a WHERE split = 'test')))), 8) "
    "AS mean_abs FROM ds_a WHERE split = 'test'" for c, w in zip(_A_FEATURES, _A_WEIGHTS)), "ds_a"))
def q_m17e(spark, d):
    """Sampled kernel SHAP over dataset A's features from their means; a linear score has w * (x - mean) as its values."""
    test = M.split_of(dataset_a(spark, d), "test")
    phis = EX.attributions(test, _A_FEATURES, _linear_score, num_samples=MF.SHAP_SAMPLES_NO_BASELINE, keep=["trip_key"])
    return _round_doubles(EX.mean_abs(phis, _A_FEATURES), 8)


@register("m17f_kernel_shap_totals_dataset_a", with_ctes(
    "SELECT count(*) AS rows, count(*) AS totals_met FROM ds_a WHERE split = 'test'", "ds_a"))
def q_m17f(spark, d):
    """Sampled kernel SHAP of a logistic score: every row's attributions add up to score - base score."""
    test = M.split_of(dataset_a(spark, d), "test")
    phis = EX.attributions(test, _A_FEATURES, EX.logistic_score(0.2, _A_WEIGHTS),
                           num_samples=MF.SHAP_SAMPLES_NO_BASELINE, keep=["trip_key"])
    total = sum((F.col(f"`phi_{c}`") for c in _A_FEATURES), F.lit(0.0))
    met = F.abs(total - (F.col("score") - F.col("base_score"))) < 1e-9
    return phis.agg(F.count(F.lit(1)).alias("rows"), F.count_if(met).alias("totals_met"))


# ------------------------------------------------------------------ streaming

@register("st1_stream_canonical_available_now", with_ctes("SELECT * FROM enriched", "enriched"))
def q_st1(spark, d):
    source = X.trips_path(spark, d)
    schema = spark.read.parquet(source).schema
    out = scratch_path(spark, "stream_out")
    return run_available_now(spark, source, schema, zones(spark, d), out, scratch_path(spark, "stream_ckpt"))


# ------------------------------------------------------------------ pyspark.ml (rows-only checks)

def _b_splits(spark, d):
    """Dataset B splits; train/validation without the key, test keeps ``trip_key`` (row id for SHAP)."""
    ds = dataset_b(spark, d)
    return (M.split_of(ds, "train").drop("trip_key"), M.split_of(ds, "validation").drop("trip_key"),
            M.split_of(ds, "test"))


# Model artifacts and trial tables per (application, input folder): queries that
# need the same fitted model or tuning run reuse the persisted artifact, as the
# reference's later steps read the trained model from storage.
_ARTIFACTS: dict[tuple, object] = {}


def _artifact(spark, d, name, build):
    key = (spark.sparkContext.applicationId, d.rstrip("/"), name)
    if key not in _ARTIFACTS:
        _ARTIFACTS[key] = build()
    return _ARTIFACTS[key]


def _job_model(spark, d):
    """The training job of the reference: GBT, 150 trees, depth 3, learning rate 0.1, seed 42."""
    train, val, test = _b_splits(spark, d)
    model = _artifact(spark, d, "job_model", lambda: L.train_boosted(
        train, "high_tip", L.Hyperparameters(**L.JOB_HYPERPARAMETERS)))
    return model, train, val, test


def _tuning_trials(spark, d, train, val):
    return _artifact(spark, d, "tuning_trials", lambda: L.tune(train, val, "high_tip")[1])


@register("m8_m9_gbt_train_and_score")
def q_m8(spark, d):
    model, _, _, test = _job_model(spark, d)
    return L.score(model, test)


@register("m8b_gbt_feature_importances")
def q_m8b(spark, d):
    model, _, _, _ = _job_model(spark, d)
    return L.feature_importances(spark, model, M.FIXED_FEATURES)


@register("f8b_name_prefix", with_ctes(
    "SELECT trip_key, pickup_zone FROM enriched WHERE starts_with(pickup_zone, 'NATION_2')", "enriched"))
def q_f8b(spark, d):
    return CL.name_contains(enriched(spark, d).select("trip_key", "pickup_zone"), "pickup_zone", "NATION_2",
                            prefix=True)


def _job_scored_test(spark, d):
    model, _, _, test = _job_model(spark, d)
    return L.score(model, test)


@register("m10b_gbt_evaluation_report")
def q_m10b(spark, d):
    return MF.evaluate(_job_scored_test(spark, d))


@register("m14b_gbt_quality_gate")
def q_m14b(spark, d):
    """Model-version row when the fitted model's test AUC clears 0.55 (appended to the versions table)."""
    versions = MF.gate(MF.evaluate(_job_scored_test(spark, d)), "taxi-models")
    return R.append_rows(versions, scratch_path(spark, "model_versions"))


@register("m16b_gbt_post_training_bias")
def q_m16b(spark, d):
    return MF.model_bias(_job_scored_test(spark, d))


@register("m17b_gbt_shap_mean_abs")
def q_m17b(spark, d):
    """Exact attributions of P(label = 1) of the fitted model, every test row, without copies of rows."""
    model, _, _, test = _job_model(spark, d)
    return EX.mean_abs(TS.probability_attributions(test, model, MF.SHAP_BASELINE, ["trip_key"]), M.FIXED_FEATURES)


@register("m12_l4_tuning_best_trial")
def q_m12(spark, d):
    train, val, _ = _b_splits(spark, d)
    return R.best_run(spark.createDataFrame(_tuning_trials(spark, d, train, val)))


@register("m13_run_log_compare")
def q_m13(spark, d):
    model, train, val, _ = _job_model(spark, d)
    base_auc = L.auc_of(model, val, "high_tip")
    trials = _tuning_trials(spark, d, train, val)
    hp = L.JOB_HYPERPARAMETERS
    rows = [("taxi-train-baseline", hp["learning_rate"], hp["max_depth"], hp["n_estimators"], "validation:auc",
             base_auc)]
    rows += [(f"taxi-hpo-{t['trial']:03d}", t["learning_rate"], t["max_depth"], t["n_estimators"], "validation:auc",
              t["validation_auc"]) for t in trials]
    runs = spark.createDataFrame(
        rows, "run_name string, learning_rate double, max_depth int, n_estimators int, metric_name string, value double")
    table = R.append_rows(R.run_log_rows(runs, "taxi-"), scratch_path(spark, "runs"))
    return R.compare_runs(table, ["validation_auc"])


@register("m19_l3_candidate_leaderboard")
def q_m19(spark, d):
    train, val, _ = _b_splits(spark, d)
    return R.leaderboard(L.rank_candidates(spark, train, val, "high_tip"))


# ------------------------------------------------------------------ relational model steps on fixed scorers

# Candidate names (the first is longer than the leaderboard's cut) and their score columns over the test split.
_FIXED_CANDIDATES = [("fixed_logistic_scorer_over_all_seven_features_v1", "score"),
                     ("distance_only", "trip_distance"), ("hour_only", "pickup_hour"), ("hour_again", "pickup_hour")]


def _auc_sql_of(column: str, source: str = "ds_b_test") -> str:
    return f"""(SELECT round(sum(pos * (coalesce(below, 0) + neg / 2.0)) / (sum(pos) * sum(neg)), 10)
        FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below
              FROM (SELECT CAST({column} AS DOUBLE) AS s, CAST(count(*) FILTER (high_tip = 1) AS DOUBLE) AS pos,
                           CAST(count(*) FILTER (high_tip = 0) AS DOUBLE) AS neg FROM {source} GROUP BY 1)))"""


_CANDIDATES_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS candidate, 'validation:auc' AS metric_name, {_auc_sql_of(column)} AS value"
    for name, column in _FIXED_CANDIDATES)


def _fixed_candidates(spark, d):
    test = scored_test(spark, d)
    return U.append_all([
        A.auc(test, "high_tip", column).select(F.lit(name).alias("candidate"), F.lit("validation:auc").alias("metric_name"),
                                               F.round("auc", METRIC_DIGITS).alias("value"))
        for name, column in _FIXED_CANDIDATES])


@register("l3_leaderboard_fixed_scorers", with_ctes(
    "SELECT CAST(row_number() OVER (ORDER BY value DESC, candidate) AS INTEGER) AS rank, "
    f"substr(candidate, 1, 44) AS candidate, metric_name, value FROM ({_CANDIDATES_SQL})", "ds_b_test"))
def q_l3(spark, d):
    return R.leaderboard(_fixed_candidates(spark, d))


@register("l4_best_fixed_scorer", with_ctes(
    f"SELECT max_by(candidate, value) AS best_candidate, max(value) AS best_value FROM ({_CANDIDATES_SQL}) "
    "WHERE candidate <> 'hour_again'", "ds_b_test"))
def q_l4(spark, d):
    return R.best_run(_fixed_candidates(spark, d).where("candidate <> 'hour_again'"), "value", "candidate")


@register("m13_run_log_fixed_scorers", with_ctes(
    "SELECT candidate AS run_name, CAST(0.1 AS DOUBLE) AS learning_rate, 3 AS max_depth, 1 AS n_estimators, "
    f"value AS validation_auc FROM ({_CANDIDATES_SQL})", "ds_b_test"))
def q_m13_fixed(spark, d):
    runs = _fixed_candidates(spark, d).select(
        F.concat(F.lit("taxi-"), F.col("candidate")).alias("run_name"), F.lit(0.1).alias("learning_rate"),
        F.lit(3).alias("max_depth"), F.lit(1).alias("n_estimators"), "metric_name", "value")
    return R.compare_runs(R.append_rows(R.run_log_rows(runs, "taxi-"), scratch_path(spark, "runs")), ["validation_auc"])


@register("m14c_gate_per_candidate", with_ctes(f"""
    WITH c AS ({_CANDIDATES_SQL})
    SELECT value AS auc, 'Approved' AS approval_status FROM c
    WHERE value >= (SELECT value FROM c WHERE candidate = 'hour_only')""", "ds_b_test"))
def q_m14c(spark, d):
    """The gate at one candidate's own AUC: that candidate passes by equality, lower ones fail."""
    found = _fixed_candidates(spark, d)
    threshold = found.where("candidate = 'hour_only'").first()["value"]
    report = F.to_json(F.struct(F.struct(F.struct(F.col("value")).alias("auc")).alias("binary_classification_metrics")))
    return R.quality_gate(found.select(report.alias("report")), threshold).select("auc", "approval_status")


@register("l6p_bernoulli_sample_properties", with_ctes(
    "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS foreign_rows, true AS near_rate FROM enriched", "enriched"))
def q_l6p(spark, d):
    """A tenth of the rows, within 6 standard deviations, each of them a row of the input."""
    rows = enriched(spark, d)
    sample = S.approx_sample(rows, 0.1, seed=42).select("trip_key").withColumn("taken", F.lit(1))
    joined = rows.select("trip_key", F.lit(1).alias("known")).join(sample, "trip_key", "full")
    n, k = F.count("known"), F.count("taken")
    return joined.agg(n.alias("rows"), F.count_if(F.col("known").isNull()).alias("foreign_rows"),
                      (F.abs(k - 0.1 * n) < 6 * F.sqrt(0.09 * n) + 1).alias("near_rate"))


@register("m8p_gbt_properties", with_ctes(
    "SELECT count(*) AS rows, count(*) AS scores_in_range, true AS beats_base_rate FROM ds_b_train", "ds_b_train"))
def q_m8p(spark, d):
    """The fitted model scores every training row within [0, 1] and ranks them better than a constant."""
    model, train, _, _ = _job_model(spark, d)
    return _fit_properties(L.score(model, train))


def _fit_properties(scored):
    auc = A.auc(scored, "high_tip").select((F.col("auc") > 0.5).alias("beats_base_rate"))
    counts = scored.agg(F.count("*").alias("rows"), F.count_if(F.col("score").between(0, 1)).alias("scores_in_range"))
    return counts.join(F.broadcast(auc))


def _a_splits(spark, d):
    """Dataset A's train, validation and test rows with plain feature names and without the key."""
    ds = CL.sanitize_columns(dataset_a(spark, d).drop("trip_key"))
    return tuple(M.split_of(ds, s) for s in SPLITS)


def _job_model_a(spark, d):
    """The training job over the one-hot table (dataset A)."""
    train, _, _ = _a_splits(spark, d)
    return _artifact(spark, d, "job_model_a", lambda: L.train_boosted(
        train, "high_tip", L.Hyperparameters(**L.JOB_HYPERPARAMETERS)))


@register("m8d_gbt_dataset_a")
def q_m8d(spark, d):
    return L.score(_job_model_a(spark, d), _a_splits(spark, d)[2])


@register("m8q_gbt_dataset_a_properties", with_ctes(
    "SELECT count(*) AS rows, count(*) AS scores_in_range, true AS beats_base_rate FROM ds_a WHERE split = 'train'",
    "ds_a"))
def q_m8q(spark, d):
    """As ``m8p_gbt_properties``, on dataset A."""
    return _fit_properties(L.score(_job_model_a(spark, d), _a_splits(spark, d)[0]))


@register("m19b_candidates_dataset_a")
def q_m19b(spark, d):
    train, val, _ = _a_splits(spark, d)
    return R.leaderboard(L.rank_candidates(spark, train, val, "high_tip"))


# ------------------------------------------------------------------ K5, K10, M4, fractional durations, NaN rows

@register("k5_feature_order", with_ctes("""
    SELECT row_number() OVER (ORDER BY grp, name) - 1 AS position, name AS feature FROM (
        SELECT 10 + list_position(['trip_distance', 'trip_duration_min', 'trip_speed_mph', 'pickup_hour',
                                   'passenger_count', 'fare_amount', 'is_airport_trip'], c) AS grp, c AS name
        FROM (SELECT unnest(['trip_distance', 'trip_duration_min', 'trip_speed_mph', 'pickup_hour',
                             'passenger_count', 'fare_amount', 'is_airport_trip']) AS c)
        UNION ALL
        SELECT 20, 'trip_distance_bucket_' || v FROM (SELECT DISTINCT trip_distance_bucket AS v FROM ds_a_card)
        WHERE v > (SELECT min(trip_distance_bucket) FROM ds_a_card)
        UNION ALL
        SELECT 30, 'pickup_borough_' || v FROM (SELECT DISTINCT pickup_borough AS v FROM ds_a_card)
        WHERE v > (SELECT min(pickup_borough) FROM ds_a_card))""", "ds_a_card"))
def q_k5(spark, d):
    """The feature order of dataset A, whose category columns come from the data, written and read back."""
    names = [c for c in dataset_a(spark, d).columns if c not in ("trip_key", "split", M.LABEL)]
    path = WR.write_lines(spark, names, scratch_path(spark, "feature_order"))
    return (spark.read.text(path, wholetext=True)
            .select(F.posexplode(F.split(F.rtrim("value", F.lit("\n")), "\n")).alias("position", "feature"))
            .select(F.col("position").cast("long").alias("position"), "feature"))


@register("k10_observed_write", with_ctes(
    "SELECT count(*) AS observed_rows, count(*) AS rows_read, count(DISTINCT pickup_hour) AS partitions FROM enriched",
    "enriched"))
def q_k10(spark, d):
    """The row count observed during the partitioned write, beside what a reader of the table counts."""
    path = scratch_path(spark, "enriched_observed")
    seen = WR.write_partitioned(P.build_pipeline(trips(spark, d), zones(spark, d)), path, "pickup_hour")
    return spark.read.parquet(path).agg(
        F.lit(int(seen["rows"])).cast("long").alias("observed_rows"), F.count(F.lit(1)).alias("rows_read"),
        F.count_distinct("pickup_hour").alias("partitions"))


# Dataset A's features of integral type; record ids are strings, all others fractional.
_A_INTEGRAL = ["high_tip", "pickup_hour", "is_airport_trip", *[s for c, s in _A_FEATURE_NAMES if c in A_DUMMY_NAMES]]


@register("m4_feature_definitions", with_ctes(
    " UNION ALL ".join(
        f"SELECT '{s}' AS feature_name, '{'Integral' if s in _A_INTEGRAL else 'Fractional'}' AS feature_type, "
        f"count(\"{c}\") AS n_values FROM ds_a WHERE split = 'train'" for c, s in _A_FEATURE_NAMES)
    + " UNION ALL SELECT 'trip_id', 'String', count(trip_key) FROM ds_a WHERE split = 'train'"
      " UNION ALL SELECT 'event_time', 'Fractional', count(*) FROM ds_a WHERE split = 'train'", "ds_a"))
def q_m4(spark, d):
    return FS.described_features(_feature_rows(spark, d))


@register("p3b_sub_second_durations", """
    SELECT event_id, CAST(epoch_us(ts) - epoch_us(date_trunc('day', ts)) AS DOUBLE) / 60000000.0 AS minutes,
           CAST(epoch_us(ts) - epoch_us(date_trunc('day', ts)) AS DOUBLE) / 60000000.0
             > floor((epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1000000) / 60.0 AS has_fraction
    FROM events""")
def q_p3b_events(spark, d):
    """Minutes since midnight of events, whose times carry microseconds; the whole-second rule (P3) would lose them."""
    events = X.table(spark, d, "events").withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    events = events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    exact, whole = C.duration_minutes_exact("day", "ts"), C.duration_minutes("day", "ts")
    return events.select("event_id", exact.alias("minutes"), (exact > whole).alias("has_fraction"))


@register("f7b_complete_cases_nan", with_ctes(
    "SELECT trip_key, trip_distance, tip_amount FROM trips "
    "WHERE tip_amount IS NOT NULL AND trip_key IS NOT NULL AND trip_distance > 0", "trips"))
def q_f7b(spark, d):
    """Complete cases over a column with NaN (zero distances, marked so) and one with nulls."""
    marked = trips(spark, d).select(
        "trip_key", F.when(F.col("trip_distance") == 0, F.lit(float("nan"))).otherwise(F.col("trip_distance"))
        .alias("trip_distance"), "tip_amount")
    return CL.complete_cases(marked)


# The queries over tree ensembles use the frames and helpers above.
from farebox import registry_trees  # noqa: E402,F401
