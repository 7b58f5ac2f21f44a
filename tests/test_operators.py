"""Operator tests: properties and brute-force comparisons on small hand tables."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.operators import aggregate as A
from farebox.operators import bias as B
from farebox.operators import compare as U
from farebox.operators import encode as E
from farebox.operators import explain as X
from farebox.operators import features as FS
from farebox.operators import learn as L
from farebox.operators import runs as R
from farebox.operators import sampling as S
from farebox.sources import readers as RD
from farebox.sources import writers as WR


def test_take_by_hash_exact_and_matches_sort(spark, monkeypatch):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    # force the multi-level histogram walk with a tiny final-take bound
    monkeypatch.setattr(S, "FINAL_TAKE_ROWS", 10)
    got = sorted(r["k"] for r in S.take_by_hash(df, 777, ["k"]).collect())
    h = S.key_hash(["k"], 42)
    want = sorted(r["k"] for r in df.orderBy(h).limit(777).collect())
    assert got == want and len(got) == 777
    assert S.take_by_hash(df, 10_000, ["k"]).count() == 5000


def test_split_is_partition_of_keys(spark):
    df = S.with_split(spark.range(20000).select(F.col("id").cast("string").alias("k")), "k")
    counts = {r["split"]: r["rows"] for r in A.split_counts(df).collect()}
    assert sum(counts.values()) == 20000 and set(counts) == {"train", "validation", "test"}
    assert 0.67 < counts["train"] / 20000 < 0.73
    again = S.with_split(spark.range(20000).select(F.col("id").cast("string").alias("k")), "k")
    assert U.frames_equal(df, again)


def test_one_hot_drop_first(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("c", 4)], "cat string, x int")
    out = E.one_hot(df, ["cat"])
    assert out.columns == ["x", "cat_b", "cat_c"]
    rows = {r["x"]: (r["cat_b"], r["cat_c"]) for r in out.collect()}
    assert rows == {1: (1, 0), 2: (0, 0), 3: (0, 0), 4: (0, 1)}
    with pytest.raises(ValueError):
        E.one_hot(df, ["cat"], max_categories=2)


def _brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_matches_pairwise_definition(spark):
    rng = np.random.default_rng(1)
    scores = np.round(rng.random(3000), 2)  # many ties
    labels = (rng.random(3000) < 0.3 + 0.4 * scores).astype(int)
    pairs = list(zip(scores.tolist(), labels.tolist()))
    df = spark.createDataFrame(pairs, "score double, label int")
    row = A.auc(df, "label", "score").first()
    assert abs(row["auc"] - _brute_auc(pairs)) < 1e-12
    acc = np.mean((scores >= 0.5).astype(int) == labels)
    assert abs(row["accuracy"] - acc) < 1e-12
    assert abs(A.accuracy(df, "label").first()["accuracy"] - acc) < 1e-12


def test_bias_metrics_against_brute_force(spark):
    rng = np.random.default_rng(7)
    n = 2000
    facet = rng.integers(0, 3, n)
    y = (rng.random(n) < 0.3 + 0.15 * facet).astype(int)
    score = np.clip(0.2 + 0.3 * y + 0.2 * rng.random(n), 0, 1)
    rows = list(zip(facet.tolist(), y.tolist(), score.tolist()))
    df = spark.createDataFrame(rows, "f int, y int, score double")
    pre = {r["facet_value"]: r for r in B.pre_training_bias(df, "f", "y").collect()}
    post = {r["facet_value"]: r for r in B.post_training_bias(df, "f", "y", "score").collect()}
    yhat = (score >= 0.5).astype(int)
    for v in range(3):
        d, a = facet == v, facet != v
        qa, qd = y[a].mean(), y[d].mean()
        pa, pd_ = np.array([1 - qa, qa]), np.array([1 - qd, qd])
        m = (pa + pd_) / 2
        kl = lambda p, q: float(np.sum(p * np.log(p / q)))
        assert pre[v]["CI"] == pytest.approx((a.sum() - d.sum()) / n)
        assert pre[v]["DPL"] == pytest.approx(qa - qd)
        assert pre[v]["KL"] == pytest.approx(kl(pa, pd_))
        assert pre[v]["JS"] == pytest.approx(0.5 * (kl(pa, m) + kl(pd_, m)))
        assert pre[v]["LP"] == pytest.approx(np.linalg.norm(pa - pd_))
        assert pre[v]["TVD"] == pytest.approx(0.5 * np.abs(pa - pd_).sum())
        assert pre[v]["KS"] == pytest.approx(np.abs(pa - pd_).max())

        def conf(mask):
            tp = np.sum((y == 1) & (yhat == 1) & mask)
            fp = np.sum((y == 0) & (yhat == 1) & mask)
            fn = np.sum((y == 1) & (yhat == 0) & mask)
            tn = np.sum((y == 0) & (yhat == 0) & mask)
            return tp, fp, fn, tn
        tpa, fpa, fna, tna = conf(a)
        tpd, fpd, fnd, tnd = conf(d)
        assert post[v]["DPPL"] == pytest.approx(yhat[a].mean() - yhat[d].mean())
        assert post[v]["DI"] == pytest.approx(yhat[d].mean() / yhat[a].mean())
        assert post[v]["RD"] == pytest.approx(tpa / (tpa + fna) - tpd / (tpd + fnd))
        assert post[v]["AD"] == pytest.approx((tpa + tna) / a.sum() - (tpd + tnd) / d.sum())
        assert post[v]["DAR"] == pytest.approx(tpa / (tpa + fpa) - tpd / (tpd + fpd))
        assert post[v]["SD"] == pytest.approx(tnd / (tnd + fpd) - tna / (tna + fpa))
        assert post[v]["DCA"] == pytest.approx(y[a].sum() / yhat[a].sum() - y[d].sum() / yhat[d].sum())
        b = yhat - y + 1
        ge = np.sum((b / b.mean()) ** 2 - 1) / (2 * n)
        assert post[v]["GE"] == pytest.approx(ge)


def _brute_shapley(f, x, base):
    p = len(x)
    phi = np.zeros(p)
    for i in range(p):
        others = [j for j in range(p) if j != i]
        for k in range(p):
            for S_ in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(p - k - 1) / math.factorial(p)
                with_i = [x[j] if (j in S_ or j == i) else base[j] for j in range(p)]
                without = [x[j] if j in S_ else base[j] for j in range(p)]
                phi[i] += w * (f(with_i) - f(without))
    return phi


def test_shap_exact_matches_definition_and_sums(spark):
    feats = ["a", "b", "c", "d"]
    w, b0 = [0.5, -1.0, 0.25, 2.0], 0.1
    rows = [(1.0, 2.0, 3.0, 0.5), (0.0, -1.0, 4.0, 1.0), (2.5, 0.5, -2.0, 0.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a double, b double, c double, d double")
    base = [0.5, 0.5, 0.5, 0.5]
    out = X.attributions(df, feats, X.logistic_score(b0, w), baseline=base, keep=["id"]).orderBy("id").collect()

    def f(v):
        return 1 / (1 + math.exp(-(b0 + sum(wi * vi for wi, vi in zip(w, v)))))

    for r, x in zip(out, rows):
        got = np.array([r[f"phi_{c}"] for c in feats])
        assert np.allclose(got, _brute_shapley(f, x, base), atol=1e-12)
        assert got.sum() == pytest.approx(r["score"] - r["base_score"], abs=1e-12)


def test_coalition_plan_follows_num_samples():
    assert len(X.coalition_plan(7)[0]) == 128
    assert len(X.coalition_plan(7, num_samples=50)[0]) == 52 and len(X.coalition_plan(20, num_samples=100)[0]) == 102
    with pytest.raises(ValueError):
        X.coalition_plan(20)


def test_kernel_shap_coefficients_close_to_exact():
    p = 6
    masks_e, coef_e = X.exact_coefficients(p)
    masks_k, coef_k = X.kernel_coefficients(p, num_samples=62, seed=3)  # all inner coalitions
    rng = np.random.default_rng(0)
    fvals = {int(m): v for m, v in zip(range(2 ** p), rng.random(2 ** p))}
    # for an additive f both must agree exactly; for any f the sum constraint holds
    add = rng.random(p)
    fa = {m: sum(add[i] for i in range(p) if (m >> i) & 1) for m in range(2 ** p)}
    e = coef_e @ np.array([fa[int(m)] for m in masks_e])
    k = coef_k @ np.array([fa[int(m)] for m in masks_k])
    assert np.allclose(e, add) and np.allclose(k, add)
    kk = coef_k @ np.array([fvals[int(m)] for m in masks_k])
    assert kk.sum() == pytest.approx(fvals[2 ** p - 1] - fvals[0])


def test_mean_abs(spark):
    df = spark.createDataFrame([(1.0, -2.0), (-3.0, 4.0)], "phi_a double, phi_b double")
    got = {r["feature"]: r["mean_abs"] for r in X.mean_abs(df, ["a", "b"]).collect()}
    assert got == {"a": 2.0, "b": 3.0}


def test_latest_records_with_hot_key(spark):
    rows = [(1, float(t), f"v{t}") for t in range(5000)] + [(2, 5.0, "x"), (2, 5.0, "y"), (3, 1.0, "z")]
    df = spark.createDataFrame(rows, "id int, event_time double, v string").repartition(8)
    got = {r["id"]: (r["event_time"], r["v"]) for r in FS.latest_records(df, "id", "event_time").collect()}
    assert got == {1: (4999.0, "v4999"), 2: (5.0, "y"), 3: (1.0, "z")}


def test_drop_duplicates_hot_copies(spark):
    df = spark.createDataFrame([(1, "a")] * 3000 + [(2, "b"), (2, "b"), (3, "c")], "k int, v string").repartition(8)
    assert sorted(tuple(r) for r in A.drop_duplicates(df).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_feature_definitions_and_ingest(spark, tmp_path):
    ok = spark.createDataFrame([("id1", 1.0, 3, "s")], "trip_id string, x double, n int, s string")
    assert FS.feature_definitions(ok) == [("trip_id", "String"), ("x", "Fractional"), ("n", "Integral"),
                                          ("s", "String")]
    with pytest.raises(TypeError):
        FS.feature_definitions(spark.createDataFrame([(True,)], "b boolean"))
    with pytest.raises(ValueError):
        FS.feature_definitions(spark.createDataFrame([(1,)], "`a b` int"))
    rows = FS.with_event_time(ok, 1704067200.0)
    path = FS.ingest(rows, str(tmp_path / "fg"))
    FS.ingest(FS.with_event_time(ok.withColumn("x", F.lit(2.0)), 1704153600.0), path)
    back = spark.read.parquet(path)
    assert back.count() == 2
    latest = FS.latest_records(back.drop("event_date"), "trip_id", "event_time").first()
    assert latest["x"] == 2.0
    bad = spark.createDataFrame([(None, 1.0)], "trip_id string, event_time double")
    with pytest.raises(Exception, match="a record lacks trip_id"):
        FS.validate_group(bad, "trip_id", "event_time").collect()
    with pytest.raises(ValueError, match="needs column"):
        FS.validate_group(bad.drop("event_time"), "trip_id", "event_time")
    described = {tuple(r) for r in FS.described_features(rows.unionByName(rows)).collect()}
    assert described == {("trip_id", "String", 2), ("x", "Fractional", 2), ("n", "Integral", 2), ("s", "String", 2),
                         ("event_time", "Fractional", 2)}


def test_frame_difference(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    diff = {(r["x"], r["side"]) for r in U.frame_difference(a, b).collect()}
    assert diff == {(1, "left_only"), (3, "right_only")}
    assert U.frames_equal(a, a) and not U.frames_equal(a, b)


def test_channel_reader_and_guards(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        RD.read_channel(spark, str(tmp_path / "missing"))
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "x.txt").write_text("1,2\n")
    with pytest.raises(FileNotFoundError):
        RD.read_channel(spark, str(tmp_path / "empty"))
    df = spark.createDataFrame([(1, 2.5), (0, 3.5)], "y int, x double")
    WR.write_csv(df, str(tmp_path / "h"), header=True)
    WR.write_csv(df, str(tmp_path / "n"), header=False)
    h, n = RD.read_channel(spark, str(tmp_path / "h")), RD.read_channel(spark, str(tmp_path / "n"))
    assert h.columns == ["y", "x"] and n.columns == ["_c0", "_c1"]
    assert sorted(tuple(r) for r in h.collect()) == sorted(tuple(r) for r in n.collect()) == [(0.0, 3.5), (1.0, 2.5)]


def test_infer_and_cast(spark):
    df = spark.createDataFrame([("1", "1.5", "true", "2024-01-01 10:00:00", "x", "N/A"),
                                ("2", "2", "false", "2024-01-02 00:00:00", "y", "3")],
                               "a string, b string, c string, d string, e string, f string")
    types = RD.infer_types(df)
    assert types == {"a": "bigint", "b": "double", "c": "boolean", "d": "timestamp_ntz", "e": "string",
                     "f": "string"}
    assert dict(RD.infer_and_cast(df).dtypes)["a"] == "bigint"


def test_hyperparameter_ranges():
    L.validate_hyperparameters(L.Hyperparameters(0.0001, 1, 1))
    L.validate_hyperparameters(L.Hyperparameters(1.0, 1000, 20))
    for bad in [L.Hyperparameters(0.00001, 10, 3), L.Hyperparameters(0.1, 0, 3), L.Hyperparameters(0.1, 10, 21)]:
        with pytest.raises(ValueError):
            L.validate_hyperparameters(bad)


def test_gate_and_metric_scrape(spark):
    rep = spark.createDataFrame(
        [('{"binary_classification_metrics":{"accuracy":{"value":0.7,"standard_deviation":"NaN"},'
          '"auc":{"value":0.55,"standard_deviation":"NaN"}}}',)], "report string")
    assert R.quality_gate(rep).count() == 1  # equality passes
    assert R.quality_gate(rep, 0.56).count() == 0
    lines = spark.createDataFrame([("epoch 1 validation_auc=0.6078",), ("noise",),
                                   ("validation_accuracy=0.7664",)], "value string")
    got = {r["metric_name"]: r["value"] for r in R.metrics_from_log(lines).collect()}
    assert got == {"validation:auc": 0.6078, "validation:accuracy": 0.7664}


def test_leaderboard_and_best_run(spark):
    c = spark.createDataFrame([("x" * 50, 0.7), ("b", 0.9), ("a", 0.9)], "candidate string, value double")
    lb = [(r["rank"], r["candidate"]) for r in R.leaderboard(c).orderBy("rank").collect()]
    assert lb == [(1, "a"), (2, "b"), (3, "x" * 44)]
    t = spark.createDataFrame([(1, 0.6), (2, 0.61), (3, 0.59)], "trial int, validation_auc double")
    assert R.best_run(t).first()["best_trial"] == 2


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (3, None)], "x int, s string")
    got = {r["column_name"]: (r["non_null"], r["nulls"], r["distinct_values"])
           for r in A.profile(df, exact_distinct=True).collect()}
    assert got == {"x": (2, 1, 2), "s": (2, 1, 1)}
    odd = spark.createDataFrame([(None, 0.0), (None, -0.0), (None, float("nan"))], "empty string, d double")
    got = {r["column_name"]: (r["non_null"], r["nulls"], r["distinct_values"], r["min_value"])
           for r in A.profile(odd, exact_distinct=True).collect()}
    assert got["empty"] == (0, 3, 0, None) and got["d"][:3] == (3, 0, 2)
    assert "Expand" not in A.profile(odd, exact_distinct=True)._jdf.queryExecution().executedPlan().toString()


def test_one_hot_rows_sum_at_most_one(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), ("c", "y"), (None, "x")], "c1 string, c2 string")
    out = E.one_hot(df, ["c1", "c2"])
    for prefix in ("c1_", "c2_"):
        cols = [c for c in out.columns if c.startswith(prefix)]
        sums = [sum(r[c] for c in cols) for r in out.collect()]
        assert max(sums) <= 1 and min(sums) == 0
    assert all(t == "int" for c, t in out.dtypes)  # never boolean (feature stores reject bool)


def test_ntz_duration_and_calendar(spark):
    from farebox.functions import columns as C
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:00:00' AS a, TIMESTAMP_NTZ'2024-01-01 10:30:30.5' AS b")
    r = df.select(C.duration_minutes("a", "b").alias("m"), C.duration_minutes_exact("a", "b").alias("e")).first()
    assert r["m"] == 30.5 and r["e"] == pytest.approx(30.508333333333333)


def test_scratch_paths_have_no_double_slash(spark):
    from farebox.session import scratch_path
    p = scratch_path(spark, "a", "b")
    assert "//" not in p.split(":", 1)[-1].lstrip("/")


def test_prefix_filter_pushed(spark, tmp_path):
    from farebox.operators import cleaning as CL
    path = str(tmp_path / "names")
    spark.createDataFrame([("NATION_1",), ("NATION_21",), ("X",)], "z string").write.parquet(path)
    df = CL.name_contains(spark.read.parquet(path), "z", "NATION_2", prefix=True)
    assert [r["z"] for r in df.collect()] == ["NATION_21"]
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    assert "StringStartsWith(z,NATION_2)" in df._jdf.queryExecution().explainString(mode)


def test_checked_broadcast_bounds(spark):
    from farebox.operators import enrich as J
    dim = spark.createDataFrame([(1, "abc"), (2, None), (3, "de")], "k int, v string")
    st = J.dimension_stats(dim, "k")
    assert (st.rows, st.distinct_keys, st.bytes) == (3, 3, 3 * 4 + 3 + 0 + 2)
    _, b = J.checked_broadcast(dim, "k")
    assert b
    _, b = J.checked_broadcast(dim, "k", max_bytes=10)
    assert not b
    _, b = J.checked_broadcast(dim, "k", max_rows=2)
    assert not b
    fact = spark.range(100).select((F.col("id") % 3 + 1).cast("int").alias("k"))
    joined = fact.join(J.checked_broadcast(dim, "k", max_rows=2)[0], "k", "left")
    assert joined.count() == 100


def test_scale_settings():
    from farebox.session import MAX_SHUFFLE_PARTITIONS, MB, scale_settings
    big = scale_settings(100 * 1024 ** 4, 8000)  # 100 TB on 1,000 executors x 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) == MAX_SHUFFLE_PARTITIONS
    mid = scale_settings(20 * 1024 ** 4, 8000)  # sized from the tenth that is shuffled
    assert int(mid["spark.sql.shuffle.partitions"]) == max(24000, int(20 * 1024 ** 4 * 0.1) // (200 * MB))
    small = scale_settings(10 * MB, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24


def test_configure_for_scale_measures_files(spark):
    from farebox.session import configure_for_scale, input_bytes, scale_settings
    keys = list(scale_settings(1, 1))
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        n = input_bytes(spark, ["/root/testdata/sf0.001/lineitem.parquet"])
        assert n > 0
        configure_for_scale(spark, ["/root/testdata/sf0.001/lineitem.parquet"], total_cores=8)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "24"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_shap_row_cap(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("k"), (F.col("id") / 10).alias("a"),
                                (F.col("id") % 7).cast("double").alias("b"))
    out = X.attributions(df, ["a", "b"], X.logistic_score(0.0, [1.0, -0.5]), baseline=[0.0, 0.0], keep=["k"],
                         row_cap=12)
    assert out.count() == 12
    assert X.attributions(df, ["a", "b"], X.logistic_score(0.0, [1.0, -0.5]), keep=["k"]).count() == 50


def test_frame_difference_multiplicity_and_nulls(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y"), (3, "y"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (3, "y"), (4, "z")], "k int, v string")
    got = sorted((r["k"], r["v"], r["side"]) for r in U.frame_difference(a, b).collect())
    want = sorted([(r["k"], r["v"], "left_only") for r in a.exceptAll(b).collect()] +
                  [(r["k"], r["v"], "right_only") for r in b.exceptAll(a).collect()])
    assert got == want == [(1, None, "left_only"), (3, "y", "left_only"), (3, "y", "left_only"),
                           (4, "z", "right_only")]
    text = a._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    plan = U.frame_difference(a, b)._jdf.queryExecution().explainString(text)
    assert plan.count("Exchange hashpartitioning") == 1
