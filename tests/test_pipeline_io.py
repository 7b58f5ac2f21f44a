"""Sinks, pipelines and the model path on the driver tables (sf0.001)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox import fixtures as X
from farebox.operators import explain as EX
from farebox.operators import learn as L
from farebox.plans import canonical as P
from farebox.plans import ml_tables as M
from farebox.session import scratch_path
from farebox.sources import readers as RD
from farebox.sources import writers as WR
from tests.conftest import SF001


def test_partitioned_write_counts_once_and_reads_back(spark):
    enriched = P.build_pipeline(X.trips(spark, SF001), X.zones(spark, SF001))
    path = scratch_path(spark, "t_k1")
    stats = WR.write_partitioned(enriched, path, "pickup_date")
    assert stats["rows"] == 4315
    back = RD.read_partitioned(spark, path, predicate=F.col("pickup_date") >= F.lit("1995-01-01").cast("date"))
    assert back.columns[-1] == "pickup_date"
    assert back.count() == enriched.where(F.col("pickup_date") >= F.lit("1995-01-01").cast("date")).count()


def test_feature_column_order_file(spark):
    cols = M.one_hot_dataset(P.build_pipeline(X.trips(spark, SF001), X.zones(spark, SF001), keep=["trip_key"])) \
        .drop("trip_key", "split").columns
    path = WR.write_lines(spark, cols, scratch_path(spark, "t_k5"))
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert lines == cols and lines[0] == "high_tip"


def test_staged_trips_equal_view(spark):
    from farebox.operators.compare import frames_equal
    assert frames_equal(X.trips(spark, SF001), X.trips_view(spark, SF001))
    assert frames_equal(X.zones(spark, SF001), X.zones_view(spark, SF001))


def test_gbt_train_score_and_model_shap(spark):
    ds = M.fixed_feature_dataset(X.trips(spark, SF001)).drop("split")
    model = L.train_gbt(ds.drop("trip_key"), "high_tip", L.Hyperparameters(0.1, 5, 2))
    scored = L.score(model, ds)
    vals = [r["score"] for r in scored.select("score").collect()]
    assert len(vals) == ds.count() and all(0.0 <= v <= 1.0 for v in vals)
    rows = ds.orderBy("trip_key").limit(5)
    base = [float(v) for v in rows.agg(*[F.avg(c) for c in M.FIXED_FEATURES]).first()]
    phis = EX.model_attributions(model, rows, M.FIXED_FEATURES, "trip_key", baseline=base)
    f = {r["trip_key"]: r["score"] for r in L.score(model, rows).collect()}
    base_row = spark.createDataFrame([tuple(base)], ", ".join(f"{c} double" for c in M.FIXED_FEATURES))
    f0 = L.score(model, base_row).first()["score"]
    for r in phis.collect():
        total = sum(r[f"phi_{c}"] for c in M.FIXED_FEATURES)
        assert total == pytest.approx(f[r["trip_key"]] - f0, abs=1e-9)


def test_hyperparameters_guard_training(spark):
    df = spark.createDataFrame([(1.0, 0.5), (0.0, 0.1)], "y double, x double")
    with pytest.raises(ValueError):
        L.train_gbt(df, "y", L.Hyperparameters(2.0, 10, 3))


def test_tuning_points_in_ranges():
    pts = L.tuning_points(4)
    assert len(pts) == 4 and len(set(pts)) == 4
    assert all(0.01 <= lr <= 0.3 and 2 <= d <= 6 for lr, d in pts)
    assert np.isclose(L.tuning_points(4)[0][0], pts[0][0])


@pytest.mark.parametrize("name", ["l6_bernoulli_sample", "m8_m9_gbt_train_and_score", "m12_l4_tuning_best_trial",
                                  "m13_run_log_compare", "m19_l3_candidate_leaderboard"])
def test_rows_only_queries_run(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF001)
    assert df.count() >= 1 and len(df.columns) >= 1


def test_compiled_trees_match_model_and_both_shap_paths_agree(spark):
    from farebox.functions import trees as TR
    ds = M.fixed_feature_dataset(X.trips(spark, SF001)).drop("split")
    model = L.train_gbt(ds.drop("trip_key"), "high_tip", L.Hyperparameters(0.2, 4, 2))
    feats = TR.gbt_feature_order(model, M.FIXED_FEATURES)
    assert feats == M.FIXED_FEATURES
    scorer = TR.gbt_probability_scorer(model)
    got = ds.select("trip_key", scorer([F.col(c) for c in feats]).alias("s2")).join(
        L.score(model, ds).select("trip_key", "score"), "trip_key")
    assert got.select(F.max(F.abs(F.col("s2") - F.col("score")))).first()[0] < 1e-12
    rows = ds.orderBy("trip_key").limit(20)
    base = [2.0, 12.0, 12.0, 14, 1, 12.0, 0]
    a = EX.attributions(rows, feats, scorer, baseline=base, keep=["trip_key"])
    b = EX.model_attributions(model, rows, feats, "trip_key", baseline=base)
    j = a.join(b.select("trip_key", *[F.col(f"phi_{c}").alias(f"m_{c}") for c in feats]), "trip_key")
    worst = j.select(F.greatest(*[F.abs(F.col(f"phi_{c}") - F.col(f"m_{c}")) for c in feats]).alias("d")) \
        .agg(F.max("d")).first()[0]
    assert j.count() == 20 and worst < 1e-12


def test_path_entry_and_etl_job(spark):
    import json

    from farebox.plans import etl_job
    trips_dir = scratch_path(spark, "t_raw")
    X.trips(spark, SF001).write.parquet(trips_dir + "/2024/01")
    zones_csv = scratch_path(spark, "t_zones")
    X.zones(spark, SF001).withColumn("service_zone", F.lit("Zone")).write.option("header", True).csv(zones_csv)
    df = P.build_pipeline_from_paths(spark, trips_dir, zones_csv)
    assert df.count() == 4315 and df.columns == P.ENRICHED_COLUMNS
    out = scratch_path(spark, "t_etl_out")
    assert etl_job.main([trips_dir, zones_csv, out]) == 0
    assert spark.read.parquet(out).count() == 4315
    for k in ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst",
              "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
              "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled"]:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    # metric report shape of the evaluation step
    scored = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.4), (0, 0.6)], "y int, score double")
    rep = json.loads(L.evaluation_report(scored, "y").first()["report"])
    m = rep["binary_classification_metrics"]
    assert m["accuracy"] == {"value": 0.5, "standard_deviation": "NaN"}
    assert m["auc"]["value"] == 0.75 and m["auc"]["standard_deviation"] == "NaN"


def test_stream_is_incremental_and_restartable(spark):
    from farebox.streaming.canonical_stream import run_available_now
    src = scratch_path(spark, "t_stream_src")
    t = X.trips(spark, SF001)
    t.where(F.col("VendorID") == 1).write.parquet(src)
    zones, out, ckpt = X.zones(spark, SF001), scratch_path(spark, "t_stream_out"), scratch_path(spark, "t_stream_ck")
    first = run_available_now(spark, src, t.schema, zones, out, ckpt).count()
    again = run_available_now(spark, src, t.schema, zones, out, ckpt).count()  # restart: nothing new
    assert again == first
    t.where(F.col("VendorID") == 2).write.mode("append").parquet(src)  # new files land
    total = run_available_now(spark, src, t.schema, zones, out, ckpt).count()
    assert total == P.build_pipeline(t, zones).count() == 4315 and total > first


def test_dynamic_partition_overwrite_keeps_other_partitions(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    path = scratch_path(spark, "t_dyn")
    WR.write_partitioned(df, path, "p")
    WR.write_partitioned(spark.createDataFrame([(3, "b")], "v int, p string"), path, "p", dynamic=True)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "b")]
    WR.write_partitioned(spark.createDataFrame([(4, "c")], "v int, p string"), path, "p")
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(4, "c")]


def test_staging_redoes_an_interrupted_write(spark):
    import hashlib

    from farebox.session import checkpoint_root, path_exists
    name, sf = "t_interrupted", "/tmp/no-such-sf"
    key = hashlib.md5(f"{sf}|{name}".encode()).hexdigest()[:16]
    final = f"{checkpoint_root(spark).rstrip('/')}/farebox/staged/{key}/{name}"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        spark.range(3).write.mode("overwrite").parquet(final)  # data without a commit marker
    finally:
        conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    assert not path_exists(spark, final + "/_SUCCESS")
    path = X.stage_path(spark, sf, name, lambda: spark.range(7), resplit=False)
    assert path == final and path_exists(spark, final + "/_SUCCESS")
    assert spark.read.parquet(path).count() == 7
    assert X.stage_path(spark, sf, name, lambda: spark.range(100), resplit=False) == final  # reused
    assert spark.read.parquet(final).count() == 7
