"""Hand-row tests for every bound and null rule of the canonical pipeline."""

import datetime as dt

import pytest

from farebox.functions import columns as C
from farebox.functions.names import is_valid_feature_name, sanitize_name, sanitize_names
from farebox.operators import cleaning as CL
from farebox.plans import canonical as P

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)

RAW_SCHEMA = (
    "trip_key string, VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
    "PULocationID int, DOLocationID int, payment_type bigint, fare_amount double, extra double, mta_tax double, "
    "tip_amount double, tolls_amount double, improvement_surcharge double, total_amount double, "
    "congestion_surcharge double, Airport_fee double"
)


def raw(key, minutes=10.0, dist=2.0, fare=10.0, total=12.0, tip=1.0, fee=0.0, rate=1.0, pay=1, pu=1, do=2,
        pickup=T0, passengers=1.0):
    drop = None if minutes is None else pickup + dt.timedelta(minutes=minutes)
    return (key, 1, pickup, drop, passengers, dist, rate, "N", pu, do, pay, fare, 0.5, 0.5, tip, 0.0, 1.0,
            total, 2.5, fee)


def zones_df(spark):
    return spark.createDataFrame([(1, "Manhattan", "Midtown"), (2, "N/A", "Outside")],
                                 "LocationID int, Borough string, Zone string")


def run(spark, rows):
    return P.build_pipeline(spark.createDataFrame(rows, RAW_SCHEMA), zones_df(spark), keep=["trip_key"])


def keys(df):
    return sorted(r["trip_key"] for r in df.select("trip_key").collect())


def test_duration_bounds_inclusive(spark):
    rows = [raw("lo", minutes=1.0, dist=0.5), raw("hi", minutes=120.0, dist=2.0),
            raw("under", minutes=0.99), raw("over", minutes=120.5), raw("neg", minutes=-5)]
    assert keys(run(spark, rows)) == ["hi", "lo"]


def test_distance_bounds_exclusive(spark):
    rows = [raw("zero", dist=0.0), raw("hundred", dist=100.0, minutes=100), raw("ok", dist=99.0, minutes=100)]
    assert keys(run(spark, rows)) == ["ok"]


def test_revenue_and_speed_bounds(spark):
    rows = [raw("fare0", fare=0.0), raw("total0", total=0.0), raw("ok")]
    assert keys(run(spark, rows)) == ["ok"]
    # 80 mph exactly is dropped, just under is kept
    rows = [raw("eighty", dist=40.0, minutes=30.0), raw("under", dist=39.99, minutes=30.0)]
    assert keys(run(spark, rows)) == ["under"]


def test_missing_required_fields(spark):
    rows = [raw("nodrop", minutes=None), raw("nopu", pu=None), raw("nodo", do=None), raw("ok")]
    assert keys(run(spark, rows)) == ["ok"]


def test_airport_flag_three_valued(spark):
    rows = [raw("fee", fee=1.75, rate=None), raw("jfk", fee=None, rate=2.0), raw("null", fee=None, rate=None),
            raw("no", fee=0.0, rate=1.0)]
    got = {r["trip_key"]: r["is_airport_trip"] for r in run(spark, rows).collect()}
    assert got == {"fee": True, "jfk": True, "null": None, "no": False}
    df = spark.createDataFrame(rows, RAW_SCHEMA).select("trip_key", C.airport_flag_01().alias("f"))
    assert {r["trip_key"]: r["f"] for r in df.collect()} == {"fee": 1, "jfk": 1, "null": 0, "no": 0}


def test_tip_pct_and_label_null_rules(spark):
    rows = [raw("notip", tip=None), raw("hi", fare=100.0, total=120.0, tip=20.004, dist=2.0),
            raw("exact20", fare=100.0, total=120.0, tip=20.0)]
    df = P.add_ml_label(run(spark, rows)).withColumn("lab01", C.high_tip_01())
    got = {r["trip_key"]: (r["tip_pct"], r["high_tip"], r["lab01"]) for r in df.collect()}
    assert got["notip"] == (None, None, 0)
    # rounded tip_pct 20.0 is not > 20 although the unrounded value is
    assert got["hi"] == (20.0, 0, 0)
    assert got["exact20"] == (20.0, 0, 0)
    raw_pct = spark.createDataFrame([raw("hi", fare=100.0, tip=20.004)], RAW_SCHEMA).select(
        C.high_tip_01(C.tip_pct(rounded=False)).alias("l")).first()["l"]
    assert raw_pct == 1


def test_payment_labels_and_bands(spark):
    rows = [raw(f"p{i}", pay=i) for i in range(0, 8)] + [raw("pnull", pay=None)]
    got = {r["trip_key"]: r["payment_label"] for r in run(spark, rows).collect()}
    assert got["p1"] == "Credit card" and got["p2"] == "Cash" and got["p6"] == "Voided trip"
    assert got["p0"] == got["p5"] == got["p7"] == got["pnull"] == "Unknown"
    bands = spark.createDataFrame([(x,) for x in [1.99, 2.0, 4.99, 5.0, 9.99, 10.0]], "trip_distance double") \
        .select(C.distance_band().alias("b")).collect()
    assert [r["b"] for r in bands] == ["short", "medium", "medium", "long", "long", "very_long"]


def test_unmatched_zone_keeps_row_and_calendar(spark):
    rows = [raw("unmatched", pu=26, do=1, pickup=dt.datetime(2024, 1, 7, 23, 30))]
    r = run(spark, rows).first()
    assert r["pickup_borough"] is None and r["dropoff_borough"] == "Manhattan"
    assert (r["pickup_hour"], r["pickup_dow"], r["pickup_date"]) == (23, "Sunday", dt.date(2024, 1, 7))


def test_output_contract(spark):
    df = run(spark, [raw("a")])
    assert df.columns[:20] == P.ENRICHED_COLUMNS
    types = dict(df.dtypes)
    assert types["pickup_ts"] == "timestamp_ntz" and types["pickup_date"] == "date"
    assert types["is_airport_trip"] == "boolean" and types["pickup_hour"] == "int"


def test_duplicate_dimension_key_raises(spark):
    zones = spark.createDataFrame([(1, "A", "x"), (1, "B", "y")], "LocationID int, Borough string, Zone string")
    with pytest.raises(ValueError):
        P.build_pipeline(spark.createDataFrame([raw("a")], RAW_SCHEMA), zones)


def test_filters_reach_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "trips")
    spark.createDataFrame([raw("a"), raw("b", dist=0.0)], RAW_SCHEMA).write.parquet(path)
    df = P.build_pipeline(spark.read.parquet(path), zones_df(spark))
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    assert "PushedFilters" in plan and "GreaterThan(trip_distance,0.0)" in plan
    assert "IsNotNull(tpep_pickup_datetime)" in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_names():
    assert sanitize_name("pickup_borough_N/A") == "pickup_borough_N_A"
    assert sanitize_name("pickup_borough_Staten Island") == "pickup_borough_Staten_Island"
    assert sanitize_name("__a  b__") == "a_b"
    with pytest.raises(ValueError):
        sanitize_names(["a b", "a/b"])
    assert is_valid_feature_name("a_b-1") and not is_valid_feature_name("a b")


def test_booleans_and_label_first(spark):
    df = spark.createDataFrame([(1.0, True, 0), (2.0, None, 1)], "x double, b boolean, y int")
    out = CL.label_first(CL.booleans_to_int(df), "y")
    assert out.columns == ["y", "x", "b"] and dict(out.dtypes)["b"] == "int"
    assert [r["b"] for r in out.collect()] == [1, None]
    assert CL.complete_cases(out).count() == 1
    nan = spark.createDataFrame([(float("nan"), 1)], "x double, y int")
    assert CL.complete_cases(nan).count() == 0
    assert CL.rename_columns(df, {"x": "z", "missing": "q"}).columns == ["z", "b", "y"]
