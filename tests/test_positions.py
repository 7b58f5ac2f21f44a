"""Global positions, first lines of many files, validation of runs."""

import pytest
from pyspark.sql import functions as F

from farebox.operators import learn as L
from farebox.operators import positions as PO
from farebox.sources import readers as RD


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rows") / "t")
    spark.range(1000, numPartitions=7).select((F.col("id") * 3).alias("v")).write.parquet(path)
    return path


def test_positions_follow_file_order(spark, folder):
    rows = PO.read_positions(spark, folder).collect()
    assert sorted(r["position"] for r in rows) == list(range(1000))
    assert all(r["v"] == 3 * r["position"] for r in rows)
    assert sorted(r["v"] for r in PO.first_rows(PO.read_positions(spark, folder), 10).collect()) == list(range(0, 30, 3))
    plan = PO.read_positions(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # rows are not moved


def test_dense_positions_and_exact_splits(spark):
    ids = [i for i in range(-300, 900) if i % 7 and i % 11 < 8]
    df = spark.createDataFrame([(i, "x") for i in ids], "k long, __n string").repartition(6)
    rows = PO.split_by_position(PO.dense_positions(df, "k")).collect()
    n = len(ids)
    assert {r["k"]: r["position"] for r in rows} == {k: i for i, k in enumerate(sorted(ids))}
    sizes = [sum(r["split"] == s for r in rows) for s in ("train", "validation", "test")]
    assert sizes == [int(0.70 * n), int(0.85 * n) - int(0.70 * n), n - int(0.85 * n)]
    assert PO.split_by_position(PO.dense_positions(df.limit(0), "k")).count() == 0
    words = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1), (None, 5)], "s string, i int").repartition(3)
    assert {(r["s"], r["i"]): r["position"] for r in PO.dense_positions(words, ["s", "i"]).collect()} == {
        (None, 5): 0, ("a", 1): 1, ("a", 2): 2, ("b", 1): 3}


def test_first_lines_are_read_in_tasks(spark, tmp_path):
    for i in range(120):
        (tmp_path / f"p {i}+.csv").write_text("y,a\n1,2\n3,4\n" if i % 2 else "a,y\n2,1\n4,3\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "other.txt").write_text("q")
    lines = RD.first_lines(spark, str(tmp_path))
    assert lines.count() == 120 and lines.select("line").distinct().count() == 2
    layouts = RD.channel_layouts(spark, str(tmp_path))
    assert {k: len(v) for k, v in layouts.items()} == {("y", "a"): 60, ("a", "y"): 60}
    got = RD.read_channel(spark, str(tmp_path))
    assert got.count() == 240 and got.agg(F.sum("y"), F.sum("a")).first() == (480.0, 720.0)
    (tmp_path / "bad.csv").write_text("y,b\n1,2\n")
    with pytest.raises(ValueError):
        RD.read_channel(spark, str(tmp_path))


def test_long_files_are_not_read_whole(spark, tmp_path):
    (tmp_path / "long.csv").write_text("y,a\n" + "1,2\n" * 2_000_000)
    assert [tuple(r) for r in RD.first_lines(spark, str(tmp_path)).select("line").collect()] == [("y,a",)]


def test_runs_outside_their_ranges_are_named(spark):
    rows = [(0.0001, 1, 1), (1.0, 1000, 20), (0.00001, 10, 3), (0.1, 0, 21), (None, 10, 3), (2.0, 2000, None)]
    df = spark.createDataFrame(rows, "learning_rate double, n_estimators int, max_depth int")
    got = [(r["accepted"], r["outside"]) for r in L.validate_runs(df).collect()]
    assert got == [(True, ""), (True, ""), (False, "learning_rate"), (False, "n_estimators,max_depth"), (False, "learning_rate"),
                   (False, "learning_rate,n_estimators,max_depth")]


def test_duplicates_by_digest_equal_distinct_rows(spark, monkeypatch):
    from farebox.operators import aggregate as A

    nan = float("nan")
    rows = [(1, None, 0.0), (None, 1, 0.0), (1, None, -0.0), (1, 1, nan), (1, 1, nan), (1, 1, None)] * 3 + [(i, i, 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "a int, b int, c double").repartition(5)
    want = sorted(map(repr, df.distinct().collect()))
    assert sorted(map(repr, A.drop_duplicates(df).collect())) == want
    plan = A.drop_duplicates(df)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    monkeypatch.setattr(A, "MAX_REPEATED_DIGESTS", 1)
    assert sorted(map(repr, A.drop_duplicates(df).collect())) == want
    monkeypatch.undo()
    # digests that clash: every row looks repeated, and columns still decide
    monkeypatch.setattr(A.F, "xxhash64", lambda *c: A.F.lit(7))
    assert sorted(map(repr, A.drop_duplicates(df).collect())) == want
    assert A.drop_duplicates(df.limit(0)).count() == 0
