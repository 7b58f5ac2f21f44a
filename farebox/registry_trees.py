"""Registered queries over tree ensembles: attributions in closed form (M17, A8), boosting in shared passes.

A small ensemble written by hand, and one grown over fixed split points, let
SQL compute the same values from every row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from farebox.functions import ensembles as E
from farebox.operators import boost
from farebox.operators import explain as EX
from farebox.operators import learn as L
from farebox.operators import runs as R
from farebox.operators import tree_shap as TS
from farebox.oracle import B_FEATURES, with_ctes
from farebox.plans import ml_tables as M
from farebox.plans import model_flow as MF
from farebox.registry import _a_splits, _b_splits, _job_model_a, _round_doubles, _shap_sql, _tuning_trials, dataset_b, register

# Our own small ensemble over dataset B: paths that meet a feature twice, a lone leaf, ties on integer features.
_TREES = (
    E.Tree((0, 3, -1, -1, 0, -1, -1), (2.0, 12.0, 0.0, 0.0, 8.0, 0.0, 0.0), (1, 2, 0, 0, 5, 0, 0), (4, 3, 0, 0, 6, 0, 0),
           (0.0, 0.0, 0.4, -0.3, 0.0, 0.25, -0.6)),
    E.Tree((5, 1, -1, 6, -1, -1, -1), (15.0, 10.0, 0.0, 0.0, 0.0, 0.0, 0.0), (1, 2, 0, 4, 0, 0, 0), (3, 6, 0, 5, 0, 0, 0),
           (0.0, 0.0, 0.15, 0.0, -0.2, 0.5, 0.35)),
    E.Tree((4, -1, 0, -1, -1), (1.0, 0.0, 5.0, 0.0, 0.0), (1, 0, 3, 0, 0), (2, 0, 4, 0, 0), (0.0, 0.1, 0.0, -0.05, 0.2)),
    E.Tree((-1,), (0.0,), (0,), (0,), (0.07,)),
)
SMALL_ENSEMBLE = E.Ensemble(tuple(B_FEATURES), _TREES, start=-0.1, scale=1.0)


def _tree_sql(tree: E.Tree, i: int = 0) -> str:
    if tree.feature[i] < 0:
        return f"CAST({tree.value[i]!r} AS DOUBLE)"
    return (f"CASE WHEN {B_FEATURES[tree.feature[i]]} <= {tree.threshold[i]!r} THEN {_tree_sql(tree, tree.left[i])} "
            f"ELSE {_tree_sql(tree, tree.right[i])} END")


_MARGIN_SQL = f"({SMALL_ENSEMBLE.start!r} + " + " + ".join(f"({_tree_sql(t)})" for t in _TREES) + ")"


def _test_rows(spark, d):
    return M.split_of(dataset_b(spark, d), "test")


@register("m17g_tree_shap_margin", with_ctes(_shap_sql("ds_b_test", MF.SHAP_BASELINE, score=_MARGIN_SQL), "ds_b_test"))
def q_m17g(spark, d):
    """Closed-form attributions of a small ensemble's margin against the exact coalitions of SQL, every test row."""
    phis = TS.attributions(_test_rows(spark, d), SMALL_ENSEMBLE, MF.SHAP_BASELINE, ["trip_key"])
    return _round_doubles(EX.mean_abs(phis, M.FIXED_FEATURES))


@register("m17h_tree_shap_per_row", with_ctes(
    _shap_sql("ds_b_test", MF.SHAP_BASELINE, per_row=True, digits=9, score=f"(1.0 / (1.0 + exp(-{_MARGIN_SQL})))"), "ds_b_test"))
def q_m17h(spark, d):
    """The same for its probability, per row and feature."""
    phis = TS.probability_attributions(_test_rows(spark, d), SMALL_ENSEMBLE, MF.SHAP_BASELINE, ["trip_key"])
    return _round_doubles(phis.select("trip_key", *[f"phi_{c}" for c in M.FIXED_FEATURES]), 9, unsigned_zero=True)


def _dataset_a_phis(spark, d):
    """Margin attributions of dataset A's fitted model for every test row, against the features' means."""
    model, test = _job_model_a(spark, d), _a_splits(spark, d)[2]
    features = list(model.features)
    return TS.attributions(test, model, EX.column_means(test, features), features), model


@register("m17i_tree_shap_dataset_a")
def q_m17i(spark, d):
    phis, model = _dataset_a_phis(spark, d)
    return EX.mean_abs(phis, list(model.features))


@register("m17j_tree_shap_totals_dataset_a", with_ctes(
    "SELECT count(*) AS rows, count(*) AS totals_met FROM ds_a WHERE split = 'test'", "ds_a"))
def q_m17j(spark, d):
    """Every row's attributions add up to the margin that plain scoring of the row gives, less the baseline's."""
    phis, model = _dataset_a_phis(spark, d)
    direct = E.score(model, phis, "direct", margin=True)
    total = sum((F.col(f"`phi_{c}`") for c in model.features), F.lit(0.0))
    met = F.abs(total - (F.col("direct") - F.col("base_margin"))) < 1e-9
    return direct.agg(F.count(F.lit(1)).alias("rows"), F.count_if(met).alias("totals_met"))


# ------------------------------------------------------------------ boosting with fixed split points

_EDGES = {"trip_distance": [2.0, 5.0, 10.0], "trip_duration_min": [10.0, 20.0, 30.0], "trip_speed_mph": [10.0, 20.0],
          "pickup_hour": [6.0, 12.0, 18.0], "passenger_count": [1.0, 2.0], "fare_amount": [8.0, 15.0, 25.0], "is_airport_trip": [0.0]}
_STUMP_RATE, _DEEP_RATE = 0.3, 0.1


def _best_sql(name: str, rows: str, margin: str) -> str:
    """CTE ``name``: the best split (feature number, threshold, gain, left and right sums) of ``rows`` at ``margin``."""
    cut = " UNION ALL ".join(f"SELECT {i} AS f, CAST({t!r} AS DOUBLE) AS t, CAST({c} AS DOUBLE) <= {t!r} AS l, g, h FROM {name}_g"
                             for i, c in enumerate(B_FEATURES) for t in _EDGES[c])
    side = lambda s: f"pow({s}g, 2) / ({s}h + {boost.L2})"
    return f"""
    {name}_g AS (SELECT *, 1 / (1 + exp(-({margin}))) - high_tip AS g,
                 (1 / (1 + exp(-({margin})))) * (1 - 1 / (1 + exp(-({margin})))) AS h FROM {rows}),
    {name}_c AS (SELECT f, t, coalesce(sum(g) FILTER (l), 0) AS lg, coalesce(sum(h) FILTER (l), 0) AS lh, count(*) FILTER (l) AS ln,
                 coalesce(sum(g) FILTER (NOT l), 0) AS rg, coalesce(sum(h) FILTER (NOT l), 0) AS rh, count(*) FILTER (NOT l) AS rn
                 FROM ({cut}) GROUP BY f, t),
    {name} AS (SELECT *, {side('l')} + {side('r')} - pow(lg + rg, 2) / (lh + rh + {boost.L2}) AS gain FROM {name}_c
               WHERE ln > 0 AND rn > 0 ORDER BY round(gain, 9) DESC, f, t LIMIT 1)"""


def _goes_left(split: str) -> str:
    return "CASE " + " ".join(f"WHEN (SELECT f FROM {split}) = {i} THEN CAST({c} AS DOUBLE) <= (SELECT t FROM {split})"
                              for i, c in enumerate(B_FEATURES)) + " END"


def _leaf_sql(split: str, side: str, rate: float) -> str:
    return f"(SELECT -{rate!r} * {side}g / ({side}h + {boost.L2}) FROM {split})"


def _boost_sql() -> str:
    start = "(SELECT ln(avg(high_tip) / (1 - avg(high_tip))) FROM rows)"
    after = f"({start} + CASE WHEN {_goes_left('a1')} THEN {_leaf_sql('a1', 'l', _STUMP_RATE)} ELSE {_leaf_sql('a1', 'r', _STUMP_RATE)} END)"
    report = lambda trial, tree, node, split, rate: (
        f"SELECT {trial} AS trial, {tree} AS tree, '{node}' AS node, (CASE f " + " ".join(
            f"WHEN {i} THEN '{c}'" for i, c in enumerate(B_FEATURES))
        + f" END) AS feature, t AS threshold, round(gain, 6) AS gain, round(-{rate!r} * lg / (lh + {boost.L2}), 8) AS left_value, "
          f"round(-{rate!r} * rg / (rh + {boost.L2}), 8) AS right_value FROM {split}")
    return f"""WITH rows AS (SELECT {', '.join(B_FEATURES)}, CAST(high_tip AS DOUBLE) AS high_tip FROM ds_b_train),
    {_best_sql('a1', 'rows', start)}, {_best_sql('a2', 'rows', after)}, {_best_sql('b', 'rows', start)},
    b_left AS (SELECT * FROM rows WHERE {_goes_left('b')}), b_right AS (SELECT * FROM rows WHERE NOT ({_goes_left('b')})),
    {_best_sql('bl', 'b_left', start)}, {_best_sql('br', 'b_right', start)}
    {' UNION ALL '.join([report(1, 1, '', 'a1', _STUMP_RATE), report(1, 2, '', 'a2', _STUMP_RATE), report(2, 1, '', 'b', _DEEP_RATE),
                         report(2, 1, 'l', 'bl', _DEEP_RATE), report(2, 1, 'r', 'br', _DEEP_RATE)])}"""


def _splits(ensembles):
    """(trial, tree, node, feature, threshold, gain, left_value, right_value) of every split; node is its path from the root."""
    out = []
    for k, ensemble in enumerate(ensembles, 1):
        for n, tree in enumerate(ensemble.trees, 1):
            stack = [(0, "")]
            while stack:
                i, path = stack.pop()
                if tree.feature[i] >= 0:
                    out.append((k, n, path, ensemble.features[tree.feature[i]], tree.threshold[i], tree.gain[i],
                                tree.value[tree.left[i]], tree.value[tree.right[i]]))
                    stack += [(tree.left[i], path + "l"), (tree.right[i], path + "r")]
    return out


@register("m12b_boosted_splits_fixed_points", with_ctes(_boost_sql(), "ds_b_train"))
def q_m12b(spark, d):
    """Two trials grown in shared passes over all training rows with fixed split points: every split, gain and child value."""
    train = M.split_of(dataset_b(spark, d), "train")
    fitted = boost.fit_trials(train, list(B_FEATURES), M.LABEL, [boost.Trial(_STUMP_RATE, 1, 2), boost.Trial(_DEEP_RATE, 2, 1)],
                              edges=[_EDGES[c] for c in B_FEATURES])
    rows = [(k, n, p, f, float(t), round(g, 6), v, w) for k, n, p, f, t, g, v, w in _splits(fitted)]
    return spark.createDataFrame(rows, "trial int, tree int, node string, feature string, threshold double, gain double, "
                                       "left_value double, right_value double").withColumns(
        {c: F.round(c, 8) for c in ("left_value", "right_value")})


@register("m12c_tuning_properties", with_ctes(
    f"SELECT {L.TUNING_TRIALS} AS trials, {L.TUNING_TRIALS} AS aucs_in_range, true AS beats_constant, true AS best_is_highest",
    "ds_b_train"))
def q_m12c(spark, d):
    """All trials are ranked by an AUC in [0, 1], the best beats a constant score and is the highest."""
    train, val, _ = _b_splits(spark, d)
    trials = spark.createDataFrame(_tuning_trials(spark, d, train, val))
    best = R.best_run(trials).select("best_validation_auc")
    return (trials.agg(F.count("*").cast("int").alias("trials"),
                       F.count_if(F.col("validation_auc").between(0, 1)).cast("int").alias("aucs_in_range"),
                       F.max("validation_auc").alias("top")).join(F.broadcast(best))
            .select("trials", "aucs_in_range", (F.col("top") > 0.5).alias("beats_constant"),
                    (F.col("top") == F.col("best_validation_auc")).alias("best_is_highest")))
