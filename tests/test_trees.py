"""Tree ensembles: closed-form Shapley values, boosting in shared passes, AUC by range cells."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.functions import ensembles as E
from farebox.operators import aggregate as A
from farebox.operators import boost
from farebox.operators import learn as L
from farebox.operators import tree_shap as TS


def random_tree(rnd, p, depth):
    rows = []

    def add(d):
        at = len(rows)
        rows.append([-1, 0.0, 0, 0, rnd.uniform(-1, 1)])
        if d and rnd.random() < 0.85:
            rows[at][:2] = [rnd.randrange(p), rnd.choice([-0.5, 0.0, 0.3])]
            rows[at][2] = add(d - 1)
            rows[at][3] = add(d - 1)
        return at

    add(depth)
    return E.Tree(*(tuple(c) for c in zip(*rows)))


def exact(f, x, base):
    p, phi = len(x), np.zeros(len(x))
    for i in range(p):
        others = [j for j in range(p) if j != i]
        for k in range(p):
            w = math.factorial(k) * math.factorial(p - k - 1) / math.factorial(p)
            for some in itertools.combinations(others, k):
                with_i = [x[j] if j in some or j == i else base[j] for j in range(p)]
                without = [x[j] if j in some else base[j] for j in range(p)]
                phi[i] += w * (f(with_i) - f(without))
    return phi


@pytest.fixture(scope="module")
def ensemble():
    rnd = random.Random(3)
    return E.Ensemble(tuple("abcde"), tuple(random_tree(rnd, 5, rnd.randint(0, 5)) for _ in range(12)), 0.2, 2.0)


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(4)
    value = lambda: rnd.choice([-1.0, -0.5, -0.2, 0.0, 0.1, 0.3, 0.7, None, float("nan")])
    data = [(i, *(value() for _ in range(5))) for i in range(40)]
    return spark.createDataFrame(data, "id long, a double, b double, c double, d double, e double"), data


@pytest.mark.parametrize("base", [[0.0, -0.5, 0.3, 0.4, -1.0], [0.3, float("nan"), -0.5, 0.0, 0.0]])
def test_closed_form_equals_all_coalitions(ensemble, rows, base):
    df, data = rows
    plain = lambda x: ensemble.margins(np.array([[math.nan if v is None else v for v in x]]))[0]
    chance = lambda x: 1 / (1 + math.exp(-2.0 * plain(x)))
    got = {r["id"]: r for r in TS.attributions(df, ensemble, base, ["id"]).collect()}
    prob = {r["id"]: r for r in TS.probability_attributions(df, ensemble, base, ["id"]).collect()}
    for i, *x in data:
        assert np.allclose([got[i][f"phi_{c}"] for c in "abcde"], exact(plain, x, base), atol=1e-12)
        assert np.allclose([prob[i][f"phi_{c}"] for c in "abcde"], exact(chance, x, base), atol=1e-12)
        assert got[i]["margin"] == pytest.approx(plain(x)) and got[i]["base_margin"] == pytest.approx(plain(base))
        assert prob[i]["score"] == pytest.approx(chance(x)) and prob[i]["base_score"] == pytest.approx(chance(base))


def test_attributions_neither_shuffle_nor_multiply_rows(spark, ensemble, rows):
    plan = TS.attributions(rows[0], ensemble, [0.0] * 5, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    assert TS.attributions(rows[0].limit(0), ensemble, [0.0] * 5, ["id"]).count() == 0
    with pytest.raises(ValueError):
        TS.attributions(rows[0], ensemble, [0.0], ["id"])
    many = E.Ensemble(tuple(f"f{i}" for i in range(20)), tuple(
        E.Tree((i, -1, -1), (0.0, 0.0, 0.0), (1, 0, 0), (2, 0, 0), (0.0, 1.0, -1.0)) for i in range(20)))
    with pytest.raises(ValueError):
        TS.probability_attributions(rows[0], many, [0.0] * 20, ["id"])


def test_ensemble_of_a_fitted_model_scores_alike(spark):
    df = spark.range(400).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("y"),
                                 ((F.col("id") % 7 > 3) != (F.col("id") % 11 > 6)).cast("int").alias("label"))
    model = L.train_gbt(df, "label", L.Hyperparameters(0.2, 4, 3))
    ours = E.from_gbt(model)
    assert E.Ensemble.from_json(ours.to_json()) == ours
    both = L.score(ours, L.score(model, df, "theirs"), "ours")
    assert both.where(F.abs(F.col("theirs") - F.col("ours")) > 1e-12).count() == 0 and both.count() == 400


def signal(spark, n=4000, parts=6):
    x = F.rand(1)
    return spark.range(n, numPartitions=parts).select(
        x.alias("x"), F.rand(2).alias("z"), F.when(F.col("id") % 50 == 0, None).otherwise(F.rand(3)).alias("w"),
        (F.rand(4) < F.when(x > 0.6, 0.9).otherwise(0.2)).cast("int").alias("y"))


def test_trials_grown_together_equal_trials_grown_alone(spark, monkeypatch):
    df = spark.createDataFrame(signal(spark).collect(), "x double, z double, w double, y int")
    trials = [boost.Trial(0.3, 1, 3), boost.Trial(0.1, 3, 5), boost.Trial(0.5, 2, 1)]
    edges = boost.bin_edges(df, ["x", "z", "w"], 8)
    together = boost.fit_trials(df.repartition(5), ["x", "z", "w"], "y", trials, edges)
    monkeypatch.setattr(boost, "CHECKPOINT_TREES", 2)  # margins written and read back on the way
    for t, e in zip(trials, together):
        alone = boost.fit_trials(df.coalesce(1), ["x", "z", "w"], "y", [t], edges)[0]
        assert len(e.trees) == t.n_trees
        for a, b in zip(e.trees, alone.trees):
            assert a.feature == b.feature and a.threshold == b.threshold
            assert np.allclose(a.value, b.value, atol=1e-9)


def test_boosting_finds_the_signal_and_ranks_features(spark):
    df = signal(spark)
    model = L.train_boosted(df, "y", L.Hyperparameters(0.2, 20, 3))
    auc = A.auc(L.score(model, df), "y").first()["auc"]
    assert auc > 0.8 and L.auc_of(model, df, "y") == auc
    imp = {r["feature"]: r["importance"] for r in L.feature_importances(spark, model, ["x", "z", "w"]).collect()}
    assert imp["x"] > 0.8 and sum(imp.values()) == pytest.approx(1.0)


def test_boosting_odd_rows(spark):
    schema = "x double, k int, y int"
    none = float("nan")
    df = spark.createDataFrame([(none, 1, 1), (None, None, 0), (1.0, 1, None), (1.0, 2, 1), (1.0, 2, 1), (2.0, 2, 0)], schema)
    model = boost.fit_trials(df, ["x", "k"], "y", [boost.Trial(0.5, 2, 2)])[0]
    assert E.score(model, df).where("score BETWEEN 0 AND 1").count() == 6
    same = spark.createDataFrame([(1.0, 1, 1)] * 5, schema)
    flat = boost.fit_trials(same, ["x", "k"], "y", [boost.Trial(0.5, 2, 2)])[0]
    assert all(t.feature == (-1,) for t in flat.trees)
    with pytest.raises(ValueError):
        boost.fit_trials(df.where("y > 5"), ["x", "k"], "y", [boost.Trial(0.5, 2, 2)])


def test_tuning_returns_the_best_trial(spark):
    df = signal(spark, 2000)
    best, trials = L.tune(df, signal(spark, 1000), "y", trees=3)
    assert [t["trial"] for t in trials] == [1, 2, 3, 4]
    top = max(trials, key=lambda t: t["validation_auc"])
    assert L.auc_of(best, signal(spark, 1000), "y") == pytest.approx(top["validation_auc"])


def pairs_auc(rows):
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg)) if pos and neg else None


def test_auc_by_group_equals_pairs(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice("ab"), rnd.choice([0.1, 0.5, -3.0, 1e300, -0.0, 0.0, float("inf"), rnd.random()]), rnd.choice([0, 1, 1]))
            for _ in range(400)] + [("a", None, 1), ("b", float("nan"), 0), ("b", 0.5, None), ("c", 0.1, 1)]
    df = spark.createDataFrame(rows, "g string, s double, y int").repartition(7)
    got = {r["g"]: r for r in A.auc_by(df, ["g"], "y", "s").collect()}
    for g in "abc":
        mine = [(s, y) for h, s, y in rows if h == g and s is not None and not math.isnan(s) and y is not None]
        want = pairs_auc(mine)
        assert got[g]["auc"] == (want if want is None else pytest.approx(want))
        assert (got[g]["positives"], got[g]["negatives"]) == (sum(y for _, y in mine), sum(1 - y for _, y in mine))
    assert [got[g]["excluded"] for g in "abc"] == [1, 2, 0]
    empty = A.auc(df.limit(0), "y", "s").collect()
    assert len(empty) == 1 and empty[0]["auc"] is None


def test_auc_plan_has_no_sketch_and_no_task_over_all_scores(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 0)], "s double, y int")
    plan = A.auc(df, "y", "s")._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "SinglePartition" in plan  # the last aggregate and the table of cells only
    assert plan.count("Window") - plan.count("WindowGroup") >= 2 and "hashpartitioning(cell" in plan
