"""DuckDB twins of the registered queries (the correctness oracle).

The driver registers only its own tables, so every oracle inlines the
trip-shaped views as CTEs.  :func:`with_ctes` adds the named CTEs and their
dependencies in order.  The SQL is written independently of the Spark code
(same fixed values, separate text).
"""

from __future__ import annotations

from farebox.fixtures import DUCKDB_TRIPS, DUCKDB_ZONES
from farebox.plans.model_flow import fixed_score_sql

# The label of each payment code.
PAYMENT_CASES = ("WHEN payment_type = 1 THEN 'Credit card' WHEN payment_type = 2 THEN 'Cash' "
                 "WHEN payment_type = 3 THEN 'No charge' WHEN payment_type = 4 THEN 'Dispute' "
                 "WHEN payment_type = 5 THEN 'Unknown' WHEN payment_type = 6 THEN 'Voided trip'")


def split_sql(key: str = "trip_key") -> str:
    b = f"(CAST(concat('0x', substr(md5(CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) % 10000)"
    return f"CASE WHEN {b} < 7000 THEN 'train' WHEN {b} < 8500 THEN 'validation' ELSE 'test' END"


def sample_qualify(n: int, key: str = "trip_key", seed: int = 42) -> str:
    return f"QUALIFY row_number() OVER (ORDER BY md5(concat_ws('|', {key}, '{seed}'))) <= {n}"


# The features of the two datasets.
_A_NUM = ["trip_distance", "trip_duration_min", "trip_speed_mph", "pickup_hour", "passenger_count", "fare_amount"]
_B_FEAT = ["trip_distance", "trip_duration_min", "trip_speed_mph", "pickup_hour", "passenger_count",
           "fare_amount", "is_airport_trip"]
# Category lists present in the card rows of the fixture (sorted; the first is dropped).
A_DISTANCE_BUCKETS = ["long", "medium", "short", "very_long"]
A_BOROUGHS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "N/A"]


def _dummies(col: str, values: list[str]) -> list[str]:
    return [f"CASE WHEN {col} = '{v}' THEN 1 ELSE 0 END AS \"{col}_{v}\"" for v in sorted(values)[1:]]


def _all_not_null(cols: list[str]) -> str:
    return " AND ".join(f"\"{c}\" IS NOT NULL" for c in cols)


_A_DUMMY_NAMES = [f"trip_distance_bucket_{v}" for v in A_DISTANCE_BUCKETS[1:]] + \
                 [f"pickup_borough_{v}" for v in A_BOROUGHS[1:]]

CTES: dict[str, tuple[list[str], str]] = {
    "trips": ([], DUCKDB_TRIPS),
    "zones": ([], DUCKDB_ZONES),
    "trips_dup": (["trips"], "SELECT * FROM trips UNION ALL SELECT * FROM trips WHERE PULocationID = 3"),
    "renamed": (["trips"], """
        SELECT trip_key, VendorID, tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts,
               passenger_count, trip_distance, RatecodeID AS rate_code_id, store_and_fwd_flag,
               PULocationID AS pu_location_id, DOLocationID AS do_location_id, payment_type, fare_amount,
               extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
               congestion_surcharge, Airport_fee AS airport_fee
        FROM trips"""),
    "f1": (["renamed"], """
        SELECT * FROM renamed WHERE pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL
          AND pu_location_id IS NOT NULL AND do_location_id IS NOT NULL"""),
    "f2": (["f1"], """
        SELECT * FROM (SELECT *, (epoch(dropoff_ts) - epoch(pickup_ts)) / 60.0 AS trip_duration_min FROM f1)
        WHERE trip_duration_min >= 1 AND trip_duration_min <= 120"""),
    "f3": (["f2"], "SELECT * FROM f2 WHERE trip_distance > 0 AND trip_distance < 100"),
    "f4": (["f3"], "SELECT * FROM f3 WHERE fare_amount > 0 AND total_amount > 0"),
    "f5": (["f4"], """
        SELECT * FROM (SELECT *, trip_distance / (trip_duration_min / 60.0) AS trip_speed_mph FROM f4)
        WHERE trip_speed_mph > 0 AND trip_speed_mph < 80"""),
    "featured": (["f5"], f"""
        SELECT *, CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour, dayname(pickup_ts) AS pickup_dow,
               CAST(pickup_ts AS DATE) AS pickup_date,
               CASE {PAYMENT_CASES} ELSE 'Unknown' END AS payment_label,
               CASE WHEN fare_amount > 0 THEN round(tip_amount / fare_amount * 100, 2) ELSE 0.0 END AS tip_pct,
               CASE WHEN trip_distance < 2 THEN 'short' WHEN trip_distance < 5 THEN 'medium'
                    WHEN trip_distance < 10 THEN 'long' ELSE 'very_long' END AS trip_distance_bucket,
               (coalesce(airport_fee, 0) > 0) OR (rate_code_id = 2) AS is_airport_trip
        FROM f5"""),
    "enriched": (["featured", "zones"], """
        SELECT f.pickup_ts, f.dropoff_ts, f.pickup_date, f.pickup_hour, f.pickup_dow, f.passenger_count,
               f.trip_distance, f.trip_distance_bucket, f.trip_duration_min, f.trip_speed_mph,
               pz.Borough AS pickup_borough, pz.Zone AS pickup_zone, dz.Borough AS dropoff_borough,
               dz.Zone AS dropoff_zone, f.is_airport_trip, f.payment_label, f.fare_amount, f.tip_amount,
               f.tip_pct, f.total_amount, f.trip_key
        FROM featured f LEFT JOIN zones pz ON f.pu_location_id = pz.LocationID
                        LEFT JOIN zones dz ON f.do_location_id = dz.LocationID"""),
    "ds_a_card": (["enriched"], f"""
        SELECT trip_key, {', '.join(_A_NUM)}, trip_distance_bucket, pickup_borough, is_airport_trip,
               coalesce(CAST(tip_pct > 20 AS INTEGER), 0) AS high_tip
        FROM enriched WHERE payment_label = 'Credit card'"""),
    "ds_a": (["ds_a_card"], f"""
        SELECT trip_key, {split_sql()} AS split, * EXCLUDE (trip_key) FROM (
          SELECT trip_key, high_tip, {', '.join(_A_NUM)}, CAST(is_airport_trip AS INTEGER) AS is_airport_trip,
                 {', '.join(_dummies('trip_distance_bucket', A_DISTANCE_BUCKETS) + _dummies('pickup_borough', A_BOROUGHS))}
          FROM ds_a_card)
        WHERE {_all_not_null(['high_tip', *_A_NUM, 'is_airport_trip'])}"""),
    "ds_b_f": (["trips"], """
        SELECT * FROM (
          SELECT *, trip_distance / (trip_duration_min / 60.0) AS trip_speed_mph FROM (
            SELECT trip_key, tpep_pickup_datetime, trip_distance, passenger_count, fare_amount, tip_amount,
                   payment_type, RatecodeID, Airport_fee,
                   CAST(epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime) AS DOUBLE) / 60000000.0
                     AS trip_duration_min
            FROM trips WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL)
          WHERE trip_duration_min >= 1 AND trip_duration_min <= 120 AND trip_distance > 0 AND trip_distance < 100
            AND fare_amount > 0)
        WHERE trip_speed_mph > 0 AND trip_speed_mph < 80"""),
    "ds_b_cc": (["ds_b_f"], f"""
        SELECT * FROM (
          SELECT trip_key,
                 coalesce(CAST((CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 ELSE 0.0 END) > 20
                          AS INTEGER), 0) AS high_tip,
                 trip_distance, trip_duration_min, trip_speed_mph,
                 CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour, passenger_count, fare_amount,
                 CAST(coalesce((coalesce(Airport_fee, 0) > 0) OR (RatecodeID = 2), false) AS INTEGER) AS is_airport_trip
          FROM ds_b_f WHERE payment_type = 1)
        WHERE {_all_not_null(['trip_key', 'high_tip', *_B_FEAT])}"""),
    "ds_b": (["ds_b_cc"], f"""
        SELECT trip_key, {split_sql()} AS split, high_tip, {', '.join(_B_FEAT)}
        FROM ds_b_cc"""),
    "ds_b_test": (["ds_b"], f"SELECT *, {fixed_score_sql()} AS score FROM ds_b WHERE split = 'test'"),
    "ds_b_train": (["ds_b"], "SELECT * FROM ds_b WHERE split = 'train'"),
}


def with_ctes(sql: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in CTES[n][0]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    if not order:
        return sql
    body = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    head = sql.lstrip()
    if head[:5].upper() == "WITH ":  # merge the query's own CTEs after ours
        return f"WITH {body},\n{head[5:]}"
    return f"WITH {body}\n{sql}"


A_DUMMY_NAMES = _A_DUMMY_NAMES
B_FEATURES = _B_FEAT
