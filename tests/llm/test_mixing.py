"""Operator 3: the fit is the optimum of its least squares, draws are per row, columns of any name stay."""

import numpy as np
import pytest

from farebox.llm import mixing

SCHEMA = "doc_id long, n_tokens long, member array<double>"


def members(spark, p, n):
    return spark.createDataFrame([(i, int(a), [float(x) for x in b]) for i, (a, b) in enumerate(zip(n, p))], SCHEMA).repartition(3)


def objective(p, n, r, goals):
    c = (p * n[:, None]).T @ p
    miss = (n * r) @ p - goals
    return miss @ np.linalg.solve(c, miss) / 2, p @ np.linalg.solve(c, miss)


@pytest.mark.parametrize("targets", [{"a": 0.6, "b": 0.4}, {"a": 0.97, "b": 0.03}, {"a": 0.02, "b": 0.98}])
def test_rates_are_the_optimum_also_out_of_reach(spark, targets):
    rnd = np.random.default_rng(4)
    a = rnd.uniform(0.2, 0.8, 600)          # no document is over 80 % of one domain: the last two targets cannot be met
    p, n = np.column_stack([a, 1 - a]), rnd.integers(1, 900, 600)
    model = mixing.fit_rates(members(spark, p, n), targets, scarce_at=0.0, absent_at=0.0)
    r = model.rates(p)
    goals = n.sum() * np.array(list(targets.values()))
    value, gradient = objective(p, n, r, goals)
    # brute force: many plain steps of the same convex problem
    best = np.ones(600)
    for _ in range(20_000):
        best = np.maximum(0, best - objective(p, n, best, goals)[1])
    start, least = objective(p, n, np.ones(600), goals)[0], objective(p, n, best, goals)[0]
    assert value - least <= 0.05 * (start - least)
    still = np.sqrt(n @ (r - np.maximum(0, r - gradient)) ** 2 / (n @ r ** 2))
    assert still <= 3 * mixing.STILL
    assert np.allclose((n * r) @ p, model.reached, rtol=1e-6) and len(model.steps) < mixing.MAX_PASSES
    if targets["a"] == 0.6:
        assert np.allclose(model.reached, goals, rtol=1e-4)


def test_report_tells_targets_goals_and_totals(spark):
    p = np.array([[1.0, 0.0, 0.0]] * 90 + [[0.0, 1.0, 0.0]] * 10)
    model = mixing.fit_rates(members(spark, p, np.full(100, 10)))
    rows = {r["domain"]: r for r in mixing.report(spark, model).collect()}
    assert rows["toxic"]["goal"] is None or rows["toxic"]["goal"] == 0
    assert rows["prose"]["present"] == 900 and rows["junk"]["target"] == 0.07
    assert rows["junk"]["reached"] == pytest.approx(rows["junk"]["goal"], rel=1e-3)


def test_scarce_domains_grow_without_bound_where_the_caller_says_so(spark):
    p = np.array([[1.0, 0.0]] * 999 + [[0.0, 1.0]])
    model = mixing.fit_rates(members(spark, p, np.full(1000, 10)), {"a": 0.9, "b": 0.1}, scarce_at=0.0, absent_at=0.0)
    assert model.reached[1] == pytest.approx(1000, rel=1e-3)
    assert mixing.fit_rates(members(spark, p, np.full(1000, 10)), {"a": 0.9, "b": 0.1}).reached[1] < 50


def test_repeated_rows_are_drawn_one_by_one_and_columns_stay(spark, monkeypatch):
    half = mixing.RateModel(np.zeros(3))
    half.steps = [(0.0, np.full(3, 0.5))]   # memberships add up to 1, so every rate is one half
    monkeypatch.setattr(mixing, "fit_rates", lambda *a: half)
    names = ["row", "m", "number", "copies", "copy", "member", "__llm_copies", "n_tokens", "a.b"]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names)
    docs = spark.createDataFrame([(1, "some words here", *names)] * 2000 + [(None, None, *names)], schema)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    kept = mixing.resample(docs, labels)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert 850 < len(rows) < 1150 and all(list(r)[2:] == names for r in rows)


def test_words_kept_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(mixing, "MEMO_BYTES", 10_000)
    made = mixing.Features()
    for i in range(50):
        made.of(" ".join(f"w{i}x{j}" for j in range(40)) + " " + "日本語" * 5000)
        assert made.size < 10_000 + 41 * (mixing._ENTRY + 20) and max(map(len, made.memo)) <= mixing.MEMO_KEY
