"""Bias metrics by facet.

The reference only configures a managed bias job (label 1 is positive, one
facet column, threshold 0.5 for predictions).  The metric definitions follow
the published descriptions (facet value *d* against the rest *a*).

Data work is one ``groupBy(facet)`` with conditional counts -- partial
aggregation, so a facet value holding most rows costs nothing extra.  All
metrics are column arithmetic on that per-facet table; totals for "the rest"
come from one global aggregate over it (a single row of counts).
Every ratio uses ``try_divide`` (null instead of an ANSI error on 0/0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.operators.aggregate import materialize

PRE_METRICS = ["CI", "DPL", "KL", "JS", "LP", "TVD", "KS"]
POST_METRICS = ["DPPL", "DI", "DCA", "DCR", "RD", "AD", "DAR", "DRR", "SD", "TE", "GE"]


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def _kl_term(p: Column, q: Column) -> Column:
    """p * ln(p / q) with 0 * ln(0/q) = 0 and null when q = 0 < p."""
    return F.when(p == 0, F.lit(0.0)).when(q == 0, F.lit(None).cast("double")).otherwise(p * F.log(p / q))


def _counts(df: DataFrame, facet: str, label: str, predicted: Column | None) -> DataFrame:
    y = (F.col(label) == 1).cast("long")
    aggs = [F.count(F.lit(1)).alias("n_d"), F.sum(y).alias("pos_d")]
    if predicted is not None:
        yh = predicted.cast("long")
        aggs += [
            F.sum(yh).alias("pred_pos_d"),
            F.sum(y * yh).alias("tp_d"),
            F.sum((1 - y) * yh).alias("fp_d"),
            F.sum(y * (1 - yh)).alias("fn_d"),
            F.sum((1 - y) * (1 - yh)).alias("tn_d"),
        ]
    # one pass over the facts; the per-facet table (one row per facet value) is
    # written once and read by both the totals job and the metric projection
    per = materialize(df.groupBy(F.col(facet).alias("facet_value")).agg(*aggs), "bias_counts")
    # Totals are one row: a global aggregate over the per-facet table, brought to
    # the driver as literals (no window funnelling a high-cardinality facet into
    # one task, no join).
    names = [a.rsplit("_", 1)[0] for a in per.columns if a.endswith("_d")]
    tot = per.agg(*[F.sum(f"{c}_d").alias(c) for c in names]).first()
    for c in names:
        per = per.withColumn(f"{c}_a", F.lit(int(tot[c] or 0)).cast("long") - F.col(f"{c}_d"))
    return per.withColumn("n_total", F.col("n_d") + F.col("n_a"))


def pre_training_bias(df: DataFrame, facet: str, label: str = "high_tip") -> DataFrame:
    """One row per facet value with CI, DPL, KL, JS, LP, TVD, KS."""
    t = _counts(df, facet, label, None)
    nd, na = F.col("n_d").cast("double"), F.col("n_a").cast("double")
    qd, qa = _div(F.col("pos_d"), nd), _div(F.col("pos_a"), na)
    t = t.withColumns({"q_d": qd, "q_a": qa})
    qd, qa = F.col("q_d"), F.col("q_a")
    md, mp = (1 - qa + 1 - qd) / 2, (qa + qd) / 2  # mixture of the two label distributions
    diff = F.abs(qa - qd)
    return t.select(
        "facet_value",
        "n_d", "n_a",
        _div(na - nd, na + nd).alias("CI"),
        (qa - qd).alias("DPL"),
        (_kl_term(1 - qa, 1 - qd) + _kl_term(qa, qd)).alias("KL"),
        ((_kl_term(1 - qa, md) + _kl_term(qa, mp) + _kl_term(1 - qd, md) + _kl_term(qd, mp)) / 2).alias("JS"),
        F.sqrt(F.lit(2.0) * diff * diff).alias("LP"),
        diff.alias("TVD"),
        diff.alias("KS"),
    )


def post_training_bias(df: DataFrame, facet: str, label: str = "high_tip", score: str = "score",
                       threshold: float = 0.5) -> DataFrame:
    """One row per facet value with the post-training metrics (prediction = score >= threshold)."""
    yhat = (F.col(score) >= F.lit(threshold)).cast("int")
    t = _counts(df, facet, label, yhat)

    def g(name, side):
        return F.col(f"{name}_{side}").cast("double")

    def rate(num, den):
        return _div(num, den)

    n = F.col("n_total").cast("double")
    d = {k: g(k, "d") for k in ["n", "pos", "pred_pos", "tp", "fp", "fn", "tn"]}
    a = {k: g(k, "a") for k in ["n", "pos", "pred_pos", "tp", "fp", "fn", "tn"]}
    # generalised entropy over all rows, b = yhat - y + 1 in {0 (FN), 1, 2 (FP)}
    tot = {k: d[k] + a[k] for k in d}
    b_sum = tot["tp"] + tot["tn"] + 2 * tot["fp"]
    b_mean = _div(b_sum, n)
    b_sq = tot["tp"] + tot["tn"] + 4 * tot["fp"]
    ge = _div(_div(b_sq, b_mean * b_mean) - n, 2 * n)
    return t.select(
        "facet_value", "n_d", "n_a",
        (rate(a["pred_pos"], a["n"]) - rate(d["pred_pos"], d["n"])).alias("DPPL"),
        _div(rate(d["pred_pos"], d["n"]), rate(a["pred_pos"], a["n"])).alias("DI"),
        (rate(a["pos"], a["pred_pos"]) - rate(d["pos"], d["pred_pos"])).alias("DCA"),
        (rate(d["n"] - d["pos"], d["n"] - d["pred_pos"]) - rate(a["n"] - a["pos"], a["n"] - a["pred_pos"])).alias("DCR"),
        (rate(a["tp"], a["tp"] + a["fn"]) - rate(d["tp"], d["tp"] + d["fn"])).alias("RD"),
        (rate(a["tp"] + a["tn"], a["n"]) - rate(d["tp"] + d["tn"], d["n"])).alias("AD"),
        (rate(a["tp"], a["tp"] + a["fp"]) - rate(d["tp"], d["tp"] + d["fp"])).alias("DAR"),
        (rate(d["tn"], d["tn"] + d["fn"]) - rate(a["tn"], a["tn"] + a["fn"])).alias("DRR"),
        (rate(d["tn"], d["tn"] + d["fp"]) - rate(a["tn"], a["tn"] + a["fp"])).alias("SD"),
        (rate(d["fn"], d["fp"]) - rate(a["fn"], a["fp"])).alias("TE"),
        ge.alias("GE"),
    )


def to_long(metrics: DataFrame, names: list[str]) -> DataFrame:
    """Wide metric table -> ``(facet_value, metric, value)`` (for reports and baselines)."""
    parts = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in names)
    return metrics.selectExpr("facet_value", f"stack({len(names)}, {parts}) AS (metric, value)")
