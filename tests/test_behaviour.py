"""Edge behaviour: missing scores, repeated sample keys, channel layouts, null dimension keys, fit input, scratch folder."""

import math

import pytest
from pyspark.sql import functions as F

from farebox import session
from farebox.operators import aggregate as A
from farebox.operators import enrich as J
from farebox.operators import learn as L
from farebox.operators import runs as R
from farebox.operators import sampling as S
from farebox.plans import ml_tables as M
from farebox.sources import readers as RD


def test_auc_leaves_out_and_counts_missing_scores(spark):
    rows = [(1, 0.9), (0, 0.1), (1, 0.1), (1, None), (0, float("nan")), (None, 0.5)]
    got = A.auc(spark.createDataFrame(rows, "label int, score double")).first()
    assert (got.auc, got.positives, got.negatives, got.excluded) == (0.75, 2, 1, 3)


@pytest.mark.parametrize("n", [1, 50, 99, 100, 150, 1000])
def test_take_by_hash_is_exact_for_repeated_keys(spark, n):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v")).repartition(4)
    got = S.take_by_hash(df, n, ["k"])
    assert got.count() == n
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, S.take_by_hash(df.repartition(3), n, ["k"]).collect()))


def _channel(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_channel_reads_headers_by_name(spark, tmp_path):
    path = _channel(tmp_path, one="y,a,b\n1,10,20\n", two="y,b,a\n0,21,11\n", empty="")
    assert sorted(map(tuple, RD.read_channel(spark, path).select("y", "a", "b").collect())) == [(0, 11, 21), (1, 10, 20)]


def test_channel_without_header_and_with_missing_values(spark, tmp_path):
    path = _channel(tmp_path, one=",1.5,2\n", two="1,,3\n")
    assert sorted(RD.read_channel(spark, path).columns) == ["_c0", "_c1", "_c2"]
    assert RD.read_channel(spark, path).count() == 2


def test_channel_with_other_columns_raises(spark, tmp_path):
    with pytest.raises(ValueError):
        RD.read_channel(spark, _channel(tmp_path, one="y,a\n1,2\n", two="1,2,3\n"))
    with pytest.raises(FileNotFoundError):
        RD.read_channel(spark, str(tmp_path / "none"))


def test_inference_loses_nothing(spark):
    df = spark.createDataFrame([("007", "1e400", "1", "5")] + [("8", "2.5", "2", "6")] * 50 + [("9", "1", "x", "7")],
                               "a string, b string, c string, d string")
    assert RD.infer_types(df) == {"a": "string", "b": "string", "c": "string", "d": "bigint"}
    sampled = RD.infer_and_cast(df, sample_fraction=0.3)
    assert sampled.where("c IS NULL").count() == 0 and {r.c for r in sampled.collect()} == {"1", "2", "x"}


def test_null_dimension_key_is_no_duplicate(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    assert J.dimension_stats(dim, "k").unique
    assert not J.dimension_stats(dim.union(dim.where("k = 1")), "k").unique


def test_long_run_names_stay_apart(spark):
    rows = [("r" * 70 + x, 0.1, 3, 1, "validation:auc", v) for x, v in (("a", 0.5), ("b", 0.6))]
    runs = spark.createDataFrame(rows, "run_name string, learning_rate double, max_depth int, n_estimators int, metric_name string, value double")
    got = R.compare_runs(R.run_log_rows(runs), ["validation_auc"]).collect()
    assert sorted((len(r.run_name), r.validation_auc) for r in got) == [(60, 0.5), (60, 0.6)]


def test_fit_input_draws_equal_rows_one_by_one(spark):
    df = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("double").alias("x"),
                                     (F.col("id") % 2).alias("y")).withColumn("y", F.when(F.col("x") < 0, 1).otherwise(F.col("y")))
    got = L.fit_input(df, "y")
    assert got.columns == df.columns
    equal = got.where("x = -1").count()
    assert 0.9 * 50_000 < equal < 1.1 * 50_000 and 0.95 * 150_000 < got.count() < 1.05 * 150_000
    assert max(got.rdd.glom().map(len).collect()) < 15_000


def test_fit_input_is_bounded_and_parallel(spark):
    df = spark.range(200_000).select((F.col("id") % 2).alias("y"), F.rand(1).alias("x"))
    got = L.fit_input(df, "y")
    assert got.rdd.getNumPartitions() > 1
    assert abs(got.count() - L.FIT_ROWS) < 3000
    assert L.fit_input(df, "y", max_rows=None).count() == 200_000
    assert L.fit_input(df.limit(100_000), "y").rdd.getNumPartitions() > 1


def test_datasets_hold_all_rows(spark):
    n = 160_000
    trips = spark.range(n).select(
        F.concat(F.lit("k"), F.col("id")).alias("trip_key"), F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.timestamp_seconds(F.col("id") + 1200).cast("timestamp_ntz").alias("tpep_dropoff_datetime"), F.lit(3.0).alias("trip_distance"),
        F.lit(1.0).alias("passenger_count"), F.lit(10.0).alias("fare_amount"), F.lit(10.0).alias("total_amount"),
        F.lit(3.0).alias("tip_amount"), F.lit(1).alias("payment_type"), F.lit(1.0).alias("RatecodeID"), F.lit(0.0).alias("Airport_fee"))
    assert M.fixed_feature_dataset(trips).count() == n
    assert M.fixed_feature_dataset(trips, sample_rows=1000).count() == 1000


def test_cluster_without_shared_folder_raises():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.checkpoint_root(Session())


def test_shuffle_partitions_are_bounded():
    settings = session.scale_settings(100 * 10**12, 8000)
    assert int(settings["spark.sql.shuffle.partitions"]) <= session.MAX_SHUFFLE_PARTITIONS
    assert math.isclose(int(session.scale_settings(0, 8)["spark.sql.shuffle.partitions"]), 24)
