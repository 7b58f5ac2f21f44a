"""Train -> evaluate -> gate -> bias -> explain, as plain function composition.

The managed DAG of the reference (preprocess, data bias, train, evaluate,
condition, create model, model bias, explain, register) becomes ordinary
DataFrame steps with tables in between.  Two scorers are offered:

* a fitted ``pyspark.ml`` GBT (the real model, M8/M9);
* a fixed logistic expression over the 7 features, used wherever results must
  be checked against SQL: every engine can evaluate it exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.operators import bias as B
from farebox.operators import explain as X
from farebox.operators import learn as L
from farebox.operators import runs as R
from farebox.plans.ml_tables import FIXED_FEATURES, LABEL

# ---------------------------------------------------------------- fixed values
# SHAP baseline row of the pipeline's explainability step (features in FIXED_FEATURES order).
SHAP_BASELINE = [2.0, 12.0, 12.0, 14, 1, 12.0, 0]
SHAP_SAMPLES_WITH_BASELINE = 50
SHAP_SAMPLES_NO_BASELINE = 100
FACET = "is_airport_trip"
# ------------------------------------------------------------------------------

# Our own fixed scoring model for SQL-checkable evaluation (not from the reference).
FIXED_SCORE_INTERCEPT = 1.0
FIXED_SCORE_WEIGHTS = [-0.1, 0.0, -0.02, 0.01, -0.1, -0.01, -0.2]


def fixed_scorer() -> X.Scorer:
    return X.logistic_score(FIXED_SCORE_INTERCEPT, FIXED_SCORE_WEIGHTS)


def with_fixed_score(df: DataFrame, out: str = "score") -> DataFrame:
    return df.withColumn(out, fixed_scorer()([F.col(c) for c in FIXED_FEATURES]))


def fixed_score_sql(prefix: str = "") -> str:
    """The same score as DuckDB SQL text."""
    z = f"CAST({FIXED_SCORE_INTERCEPT!r} AS DOUBLE)"
    for w, c in zip(FIXED_SCORE_WEIGHTS, FIXED_FEATURES):
        z = f"({z} + CAST({w!r} AS DOUBLE) * CAST({prefix}{c} AS DOUBLE))"
    return f"(1.0 / (1.0 + exp(-{z})))"


def evaluate(scored: DataFrame) -> DataFrame:
    """Evaluate step: the one-row metric report (accuracy, AUC, JSON text)."""
    return L.evaluation_report(scored, LABEL)


def gate(report: DataFrame, model_name: str, threshold: float = R.AUC_GATE) -> DataFrame:
    """Condition + register: model-version rows to append (empty when AUC < threshold)."""
    return R.quality_gate(report, threshold, {"model_package_group": model_name})


def data_bias(train: DataFrame) -> DataFrame:
    return B.pre_training_bias(train, FACET, LABEL)


def model_bias(scored: DataFrame) -> DataFrame:
    return B.post_training_bias(scored, FACET, LABEL, "score")


def explain_fixed(df: DataFrame, baseline: list[float] | None = SHAP_BASELINE) -> DataFrame:
    """Explainability step with the fixed scorer: per-row attributions."""
    return X.attributions(df, FIXED_FEATURES, fixed_scorer(), baseline=baseline, keep=["trip_key"])
