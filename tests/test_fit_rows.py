"""Fits run over every training row, however many there are; histograms count every row once."""

import dataclasses
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox import registry
from farebox.operators import boost
from farebox.operators import learn as L
from farebox.plans import ml_tables as M

N = 160_000      # more than a fit once drew


def made(spark, n=N):
    """(x, y): positives are every third row, and every row with x <= 20 besides."""
    x = (F.abs(F.xxhash64("id")) % 100).cast("double")
    return spark.range(n).select(x.alias("x"), F.when(x <= 20, 1).otherwise((F.col("id") % 3 == 0).cast("int")).alias("y"))


def log_odds(df, label="y"):
    rate = df.agg(F.avg(label)).first()[0]
    return math.log(rate / (1 - rate))


def datasets(spark):
    """A table in dataset A's and B's form: ``N`` training rows, a few for validation and test."""
    rows = made(spark, N + 2_000).withColumn("id", F.monotonically_increasing_id())
    split = F.when(F.col("id") % 160 < 158, "train").when(F.col("id") % 160 == 158, "validation").otherwise("test")
    ds = rows.select(F.col("id").cast("string").alias("trip_key"), split.alias("split"), F.col("y").alias(M.LABEL),
                     F.col("x").alias(M.FIXED_FEATURES[0]), *[F.lit(1.0).alias(c) for c in M.FIXED_FEATURES[1:]])
    return ds.localCheckpoint()


@pytest.fixture
def fits(spark, monkeypatch):
    """(rows, trials, start) of every fit over the made datasets; each trial grows one tree only."""
    seen, fit = [], boost.fit_trials

    def one_tree(df, features, label, trials, edges=None):
        got = fit(df, features, label, [dataclasses.replace(t, n_trees=1) for t in trials], edges)
        seen.append((df.count(), len(trials), got[0].start))
        return got

    ds = datasets(spark)
    train = M.split_of(ds, "train")
    monkeypatch.setattr(boost, "fit_trials", one_tree)
    monkeypatch.setattr(registry, "dataset_a", lambda spark, d: ds)
    monkeypatch.setattr(registry, "dataset_b", lambda spark, d: ds)
    return seen, train.count(), log_odds(train, M.LABEL)


def run_query(spark, fits, name, trials):
    seen, rows, start = fits
    assert rows > 150_000
    got = registry.QUERIES[name](spark, f"/made/{name}").collect()
    assert [(n, t) for n, t, _ in seen] == [(rows, t) for t in trials]
    assert all(s == pytest.approx(start, abs=1e-12) for _, _, s in seen)
    return got, rows


def test_tuning_fits_on_every_row(spark):
    df = made(spark)
    best, _ = L.tune(df, made(spark, 3_000), "y", trials=2, trees=1)
    assert best.start == pytest.approx(log_odds(df), abs=1e-12)


def test_best_trial_query_fits_on_every_row(spark, fits):
    got, _ = run_query(spark, fits, "m12_l4_tuning_best_trial", [L.TUNING_TRIALS])
    assert len(got) == 1 and got[0]["best_validation_auc"] > 0.5


def test_tuning_properties_query_fits_on_every_row(spark, fits):
    got, _ = run_query(spark, fits, "m12c_tuning_properties", [L.TUNING_TRIALS])
    assert [tuple(r) for r in got] == [(L.TUNING_TRIALS, L.TUNING_TRIALS, True, True)]


def test_boosting_fits_on_every_row(spark):
    df = made(spark)
    model = L.train_boosted(df, "y", L.Hyperparameters(0.5, 1, 1))
    tree, rate = model.trees[0], 1 / (1 + math.exp(-log_odds(df)))
    assert model.start == pytest.approx(log_odds(df), abs=1e-12)
    sides = {r["left"]: r for r in df.groupBy((F.col("x") <= tree.threshold[0]).alias("left")).agg(F.count("*").alias("n"), F.sum("y").alias("k")).collect()}
    for node, left in ((tree.left[0], True), (tree.right[0], False)):
        n, k = sides[left]["n"], sides[left]["k"]
        assert tree.value[node] == pytest.approx(-0.5 * (n * rate - k) / (n * rate * (1 - rate) + boost.L2), rel=1e-9)


def test_run_log_query_fits_on_every_row(spark, fits):
    got, _ = run_query(spark, fits, "m13_run_log_compare", [1, L.TUNING_TRIALS])
    assert sorted(r["run_name"] for r in got) == ["hpo-001", "hpo-002", "hpo-003", "hpo-004", "train-baseline"]


def test_dataset_a_scores_come_from_a_fit_on_every_row(spark, fits):
    got, _ = run_query(spark, fits, "m8d_gbt_dataset_a", [1])
    assert got and all(0 <= r["score"] <= 1 for r in got)


def test_dataset_a_properties_come_from_a_fit_on_every_row(spark, fits):
    got, rows = run_query(spark, fits, "m8q_gbt_dataset_a_properties", [1])
    assert [tuple(r) for r in got] == [(rows, rows, True)]


@pytest.mark.parametrize("blocks", [1, 3])
def test_histograms_count_every_row_of_every_block(monkeypatch, blocks):
    monkeypatch.setattr(boost, "_CHUNK_ROWS", 70)
    monkeypatch.setattr(boost, "_JOINT_BINS", 64)      # features 0 and 1 together, 2 and 3 together, 4 alone
    edges = [[0.0, 1.0, 2.0], [float(i) for i in range(15)], [float(i) for i in range(31)], [0.0], [0.0, 0.5]]
    widths = [1 + len(e) for e in edges]
    assert boost._together(widths, 3) == [(0, 1), (2, 3), (4,)]
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.choice([*e, math.nan, -5.0, 99.0], 500) for e in edges])
    bins, y = boost._binned(x, edges), rng.integers(0, 2, 500).astype(float)
    margins = rng.normal(size=(2, 500))
    leaf = [-1, 0, 0, 0, 0.0, 0.0]
    grown = [[2, 7, 1, 2, 0.0, 1.0], leaf, [0, 1, 3, 4, 0.0, 1.0], leaf, leaf]      # node 1 is finished
    parts = [(bins[:, p], y[p], margins[:, p]) for p in np.array_split(np.arange(500), blocks)]
    got = dict(boost._histograms(iter(parts), [([leaf], [0]), (grown, [3, 4])], widths))
    assert sorted(got) == [(0, 0), (1, 0), (1, 1)]
    in_right = ~(x[:, 2] <= 7)
    members = {(0, 0): np.full(500, True), (1, 0): in_right & (x[:, 0] <= 1), (1, 1): in_right & ~(x[:, 0] <= 1)}
    for (t, i), rows in members.items():
        p = 1 / (1 + np.exp(-margins[t]))
        for k, w in enumerate((p - y, p * (1 - p), np.ones(500))):
            for j, e in enumerate(edges):
                inside = np.array([np.isnan(x[:, j]) | (x[:, j] > e[-1]) if b == len(e) else
                                   (x[:, j] <= e[b]) & (x[:, j] > (e[b - 1] if b else -math.inf)) for b in range(widths[j])])
                assert np.allclose(got[t, i][k, j, :widths[j]], (inside & rows) @ w, atol=1e-9)
    assert list(boost._histograms(iter([]), [([leaf], [0])], widths)) == []


def test_bins_of_missing_values_and_odd_edges():
    x = np.array([[0.0], [-0.0], [1.5], [math.nan], [math.inf], [-math.inf]])
    assert boost._binned(x, [[-0.0, 1.0]])[0].tolist() == [0, 0, 2, 2, 2, 0]
    assert boost._binned(x, [[1.0, math.nan, -1.0]])[0].tolist() == [1, 1, 2, 3, 2, 0]
    assert boost._binned(x, [[]])[0].tolist() == [0] * 6


def test_blocks_are_bounded_and_lose_no_row(spark, monkeypatch):
    monkeypatch.setattr(boost, "_BLOCK_ROWS", 300)
    df = spark.range(2_000, numPartitions=3).select(F.when(F.col("id") % 9 > 0, F.col("id")).alias("x.y"), (F.col("id") % 2).alias("y"))
    held = boost._blocks(df, ["x.y"], "y", [[999.0]]).map(lambda b: (b[0].shape, len(b[1]), float(b[1].sum()), int(b[0].sum()))).collect()
    assert sum(n for _, n, _, _ in held) == 2_000 and sum(y for _, _, y, _ in held) == 1_000
    assert all(shape == (1, n) for shape, n, _, _ in held)
    assert sum(b for _, _, _, b in held) == sum(1 for i in range(2_000) if i % 9 == 0 or i > 999)
    assert max(n for _, n, _, _ in held) == 300


@pytest.mark.parametrize("rows, cores, parts", [(0, 8, 2), (15_000, 8, 2), (150_000, 8, 15), (300_000, 8, 16), (2_944_660, 8, 16),
                                                 (5_000_000, 8, 24), (2_944_660, 64, 128), (10**9, 64, 4032)])
def test_partitions_of_a_fit_grow_in_waves(rows, cores, parts):
    assert L.fit_partitions(rows, cores) == parts
