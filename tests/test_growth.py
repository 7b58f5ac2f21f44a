"""What grows with the input: bytes to the driver, rows copied, bytes written."""

import pickle

from pyspark import RDD
from pyspark.sql import functions as F

from farebox.operators import aggregate as A
from farebox.operators import boost
from farebox.registry import QUERIES
from farebox.session import list_files
from farebox.sources import readers as RD
from farebox.sources import writers as WR


def test_boosting_sends_splits_to_the_driver_and_no_histograms(spark, monkeypatch):
    names = [f"x{i}" for i in range(20)]
    df = spark.range(600).select(*[(F.abs(F.xxhash64("id", F.lit(i))) % 1000).cast("double").alias(x) for i, x in enumerate(names)],
                                 (F.abs(F.xxhash64("id", F.lit(3))) % 1000 + F.col("id") % 300 > 600).cast("double").alias("y"))
    edges = [[float(t) for t in range(30, 1000, 35)]] * len(names)
    trials = [boost.Trial(0.3, 4, 2), boost.Trial(0.1, 2, 1)]
    got, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: got.append(collect(self)) or got[-1])

    def fit(parts):
        got.clear()
        fitted = boost.fit_trials(df.repartition(parts, F.xxhash64(*names)), names, "y", trials, edges)
        return [[(t.feature, t.threshold, t.left, t.right) for t in e.trees] for e in fitted], len(pickle.dumps(got))

    few, few_bytes = fit(2)
    many, many_bytes = fit(9)
    assert any(f >= 0 for tree in few[0] for f in tree[0])
    assert few == many
    assert max(few_bytes, many_bytes) < 30_000          # a histogram of a node alone has 14,400 bytes
    monkeypatch.setattr(boost, "_FAN_IN", 2)            # sums of sums of neighbouring partitions
    monkeypatch.setattr(boost, "_NODES_A_TASK", 1)
    assert fit(9)[0] == few


def test_exact_profile_copies_no_row_and_makes_no_text(spark):
    df = spark.createDataFrame([(1, "a", -0.0, [1.0], b"\x01", None), (None, "b", -0.0, [1.0], b"\x02", None), (3, None, None, None, b"\x02", None),
                                (3, "b", float("nan"), [2.0], None, None)],
                               "`x.y` int, s string, d double, a array<double>, b binary, none timestamp")
    got = A.profile(df, exact_distinct=True)
    assert [tuple(r)[:4] for r in got.collect()] == [("x.y", 3, 1, 2), ("s", 3, 1, 2), ("d", 3, 1, 2), ("a", 3, 1, 2), ("b", 3, 1, 2), ("none", 0, 4, 0)]
    assert [tuple(r)[4:] for r in got.collect()][:4] == [("1", "3"), ("a", "b"), ("-0.0", "NaN"), ("[1.0]", "[2.0]")]
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r)[1:] for r in A.profile(df.limit(0), exact_distinct=True).collect()} == {(0, 0, 0, None, None)}


def test_duplicate_digests_are_one_number_per_row(spark, monkeypatch):
    kept, materialize = [], A.materialize
    monkeypatch.setattr(A, "materialize", lambda df, name: kept.append(df.dtypes) or materialize(df, name))
    df = spark.range(40).select((F.col("id") % 30).alias("id"), F.lit("x").alias("s"))
    assert A.drop_duplicates(df).count() == 30
    assert [[t for _, t in types] for types in kept] == [["bigint"]]


def test_compressed_csv_parts_hold_the_same_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', 1.5), (2, None, None), (3, "N/A", -0.0)] * 20, "i int, s string, d double").repartition(3)
    plain, packed = WR.write_csv(df, str(tmp_path / "plain")), WR.write_csv(df, str(tmp_path / "packed"), compression="gzip")
    assert not list((tmp_path / "plain").glob("*.gz")) and list((tmp_path / "packed").glob("*.csv.gz"))
    rows = [sorted(map(repr, RD.read_csv(spark, p, header=True, infer=True).collect())) for p in (plain, packed)]
    assert rows[0] == rows[1] and len(rows[0]) == 60


def test_visual_flow_csv_is_written_compressed(spark, monkeypatch):
    paths, write = [], WR.write_csv
    monkeypatch.setattr(WR, "write_csv", lambda *a, **k: paths.append(write(*a, **k)) or paths[-1])
    QUERIES["k7_s3_visual_flow_csv"](spark, "/root/testdata/sf0.001")
    names = [f.rsplit("/", 1)[-1] for f in list_files(spark, paths[0])]
    assert names and all(n.endswith(".csv.gz") for n in names)
