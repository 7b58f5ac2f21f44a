"""Physical-plan assertions for the scale properties the design relies on."""

import re

import numpy as np
import pytest

import __spark_entry__ as E
from farebox.operators import aggregate as A
from farebox.operators import learn as L
from tests.conftest import SF001


def plan(spark, df, mode="formatted"):
    m = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(m)


def ops(spark, df):
    """Physical operator names, top-down."""
    return re.findall(r"[+:-]- (\w+)", plan(spark, df, "simple"))


def test_canonical_pipeline_has_no_shuffle(spark):
    p = plan(spark, E.queries()["m20_canonical_enriched"](spark, SF001))
    physical = p.split("== Physical Plan ==")[-1].split("\n\n")[0]
    assert "BroadcastHashJoin" in physical
    assert "Exchange hashpartitioning" not in physical and "SortMergeJoin" not in physical
    assert "PushedFilters: [IsNotNull(trip_distance), IsNotNull(fare_amount)" in p


def test_groupings_aggregate_before_the_shuffle(spark):
    for name in ["a2_l1_borough_tip_report", "a4_drop_duplicates", "m6_latest_record_per_id",
                 "m17_a8_shap_mean_abs"]:
        text = plan(spark, E.queries()[name](spark, SF001), "simple")
        assert re.search(r"partial_|HashAggregate\(keys=\[[^\]]*\], functions=\[\]\)", text), name
        # each Exchange sits above a partial aggregate (map-side combine), never right above a scan
        lines = [l.strip() for l in text.split("\n")]
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" in line or "Exchange SinglePartition" in line:
                below = " ".join(lines[i + 1:i + 3])
                assert "Aggregate" in below, (name, line, below)


def test_latest_record_uses_aggregate_not_window(spark):
    o = ops(spark, E.queries()["m6_latest_record_per_id"](spark, SF001))
    assert "Window" not in o and any(x.endswith("Aggregate") for x in o)


def test_exact_sample_is_a_filter_not_a_global_top_k(spark):
    from farebox import fixtures as X
    from farebox.operators import sampling as S
    df = S.take_by_hash(X.trips(spark, SF001), 100, ["trip_key"])
    text = plan(spark, df, "simple")
    assert df.count() == 100
    assert "TakeOrderedAndProject" not in text and "Filter" in text and "Exchange" not in text


def test_shap_per_row_path_has_no_join_and_one_exchange(spark):
    o = ops(spark, E.queries()["m17_a8_shap_mean_abs"](spark, SF001))
    assert not any("Join" in x for x in o) and "Generate" in o  # Generate is the final stack() of 7 rows
    assert o.count("Exchange") == 1


def test_auc_exchanges_never_single_partition_on_rows(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(s), int(y)) for s, y in zip(rng.random(500), rng.integers(0, 2, 500))],
                               "score double, label int")
    text = plan(spark, A.auc(df, "label", "score"), "simple")
    # the only un-partitioned window runs over the bounded bucket table, joined back by broadcast
    assert "BroadcastHashJoin" in text or "BroadcastExchange" in text
    assert "Window" in text


def test_gbt_beats_base_rate_on_planted_signal(spark):
    rng = np.random.default_rng(11)
    n = 3000
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = ((x1 + 0.3 * rng.normal(size=n)) > 0).astype(int)
    df = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(y, x1, x2)], "y int, x1 double, x2 double")
    train, test = df.randomSplit([0.7, 0.3], seed=1)
    model = L.train_gbt(train, "y", L.Hyperparameters(0.1, 20, 3))
    auc = A.auc(L.score(model, test), "y").first()["auc"]
    assert auc > 0.85  # a base-rate model scores 0.5
    imp = {r["feature"]: r["importance"] for r in L.feature_importances(spark, model, ["x1", "x2"]).collect()}
    assert imp["x1"] > imp["x2"] and sum(imp.values()) == pytest.approx(1.0)
