"""Property-based checks (hypothesis) of the custom distributed algorithms against their definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from farebox.operators import aggregate as A
from farebox.operators import compare as U
from farebox.operators import sampling as S

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

rows = st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.sampled_from(["a", "b"]))), max_size=25)


@SETTINGS
@given(left=rows, right=rows)
def test_frame_difference_equals_except_all(spark, left, right):
    a = spark.createDataFrame(left, "k int, v string")
    b = spark.createDataFrame(right, "k int, v string")
    got = sorted((r["k"], r["v"] or "", r["side"]) for r in U.frame_difference(a, b).collect())
    want = sorted([(r["k"], r["v"] or "", "left_only") for r in a.exceptAll(b).collect()] +
                  [(r["k"], r["v"] or "", "right_only") for r in b.exceptAll(a).collect()])
    assert got == want


scored = st.lists(st.tuples(st.sampled_from([0.1, 0.2, 0.5, 0.7, 0.9]), st.integers(0, 1)), min_size=2, max_size=40)


@SETTINGS
@given(pairs=scored)
def test_auc_equals_pairwise_definition(spark, pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    row = A.auc(spark.createDataFrame(pairs, "score double, label int"), "label", "score").first()
    if not pos or not neg:
        assert row["auc"] is None
        return
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(row["auc"] - want) < 1e-12


@SETTINGS
@given(n_rows=st.integers(0, 300), n=st.integers(1, 200))
def test_take_by_hash_returns_the_smallest_hashes(spark, n_rows, n):
    from pyspark.sql import functions as F
    df = spark.range(n_rows).select(F.col("id").cast("string").alias("k"))
    got = sorted(r["k"] for r in S.take_by_hash(df, n, ["k"]).collect())
    want = sorted(r["k"] for r in df.orderBy(S.key_hash(["k"], 42)).limit(n).collect())
    assert got == want and len(got) == min(n, n_rows)
