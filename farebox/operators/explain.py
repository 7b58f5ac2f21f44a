"""Shapley attributions and their ``mean_abs`` aggregate.

The reference hands rows to a managed Kernel SHAP job that calls the model
``num_samples`` times per row.  Here one coalition table is shared by all rows,
so each feature's attribution is a fixed linear combination of the scores of
the coalitions: ``phi_i(x) = sum_k coef[i, k] * f(mix(x, baseline, z_k))``.

* without ``num_samples``: all ``2^p`` coalitions with the exact Shapley
  weights (``+w(|S|-1)`` if i in S else ``-w(|S|)``, ``w(s)=s!(p-s-1)!/p!``).
* with it: ``num_samples`` seeded coalitions plus the empty and full ones,
  with the kernel-weighted least-squares solution under the sum constraint;
  the ``p x m`` coefficient matrix depends only on the coalitions and is solved
  once on the driver with numpy.

For a score written as a Spark expression (:func:`logistic_score`), all
coalition scores of a row are one ``transform`` over a literal array of masks
and each attribution one ``aggregate`` -- per-row JVM expressions, no join and
no shuffle.  For a fitted ``pyspark.ml`` model, :func:`model_attributions`
explodes each row into its coalitions, scores them with ``model.transform`` and
sums per row id; all coalitions of a row are in one task, so the partial
aggregate collapses them before the exchange (one shuffled row per input row).
A fitted GBT can also be turned into a scorer expression
(:mod:`farebox.functions.trees`).  ``row_cap`` keeps the reference's row cap
available as an argument; by default every row is explained.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Scorer = Callable[[list[Column]], Column]


def logistic_score(intercept: float, weights: list[float]) -> Scorer:
    """A fixed logistic model ``1 / (1 + exp(-(b + w.x)))`` as a column expression builder."""
    def score(xs: list[Column]) -> Column:
        z = F.lit(float(intercept))
        for w, x in zip(weights, xs):
            z = z + F.lit(float(w)) * x.cast("double")
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return score


def exact_coefficients(p: int) -> tuple[np.ndarray, np.ndarray]:
    """All 2^p masks and the exact Shapley coefficient matrix (p x 2^p)."""
    masks = np.arange(2 ** p, dtype=np.int64)
    sizes = np.array([bin(m).count("1") for m in masks])

    def w(s):
        return math.factorial(s) * math.factorial(p - s - 1) / math.factorial(p)

    coef = np.zeros((p, len(masks)))
    for i in range(p):
        has = (masks >> i) & 1 == 1
        for k, m in enumerate(masks):
            coef[i, k] = w(sizes[k] - 1) if has[k] else -w(sizes[k])
    return masks, coef


def kernel_coefficients(p: int, num_samples: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Sampled coalitions (+ empty + full) and the constrained kernel-WLS coefficient matrix."""
    rng = np.random.default_rng(seed)
    full, empty = (1 << p) - 1, 0
    sampled = set()
    limit = min(num_samples, 2 ** p - 2)
    while len(sampled) < limit:
        m = int(rng.integers(1, full))
        sampled.add(m)
    inner = np.array(sorted(sampled), dtype=np.int64)
    Z = ((inner[:, None] >> np.arange(p)) & 1).astype(float)
    s = Z.sum(1)
    pi = (p - 1) / (np.array([math.comb(p, int(k)) for k in s]) * s * (p - s))
    A = Z.T @ (Z * pi[:, None])  # p x p
    Ainv = np.linalg.pinv(A)
    ones = np.ones(p)
    # phi_u = Ainv Z^T W (f - f0); phi = phi_u - Ainv 1 (1^T phi_u - (f_full - f0)) / (1^T Ainv 1)
    B = Ainv @ (Z.T * pi)  # p x m, acts on (f_k - f0)
    c = Ainv @ ones / (ones @ Ainv @ ones)  # p
    # coefficients on [f_empty, f_1..f_m, f_full]
    coef_inner = B - np.outer(c, ones @ B)
    coef_full = c
    coef_empty = -(coef_inner.sum(1)) - coef_full
    masks = np.concatenate([[empty], inner, [full]])
    coef = np.column_stack([coef_empty, coef_inner, coef_full])
    return masks, coef


def coalition_plan(p: int, num_samples: int | None = None, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Exact coalitions where ``num_samples`` is None, else that many sampled ones, whatever the number of features."""
    if num_samples is not None:
        return kernel_coefficients(p, num_samples, seed)
    if p > 16:
        raise ValueError("exact Shapley values need 2^p coalitions; pass num_samples for p > 16")
    return exact_coefficients(p)


def column_means(df: DataFrame, features: list[str]) -> list[float]:
    """Baseline when none is given: feature means of the input (one aggregate)."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in features]).first()
    return [float(row[c]) for c in features]


def _capped(df: DataFrame, row_cap: int | None, key_cols: list[str] | None) -> DataFrame:
    """Optional cost cap: the first ``row_cap`` rows by key hash (default: every row)."""
    if row_cap is None:
        return df
    from farebox.operators.sampling import take_by_hash
    return take_by_hash(df, row_cap, key_cols or list(df.columns), seed=0)


def attributions(df: DataFrame, features: list[str], scorer: Scorer, baseline: list[float] | None = None,
                 num_samples: int | None = None, keep: list[str] | None = None, seed: int = 42,
                 row_cap: int | None = None) -> DataFrame:
    """Per-row ``phi_<feature>`` columns plus ``score`` and ``base_score`` (scored expression path).

    ``row_cap`` keeps the reference's cost cap (300 rows) available; by default every row is explained.
    """
    df = _capped(df, row_cap, keep)
    p = len(features)
    base = column_means(df, features) if baseline is None else [float(b) for b in baseline]
    masks, coef = coalition_plan(p, num_samples, seed=seed)
    mask_arr = F.array(*[F.lit(int(m)) for m in masks])

    def mixed(m: Column) -> list[Column]:
        return [F.when(F.shiftright(m, i).bitwiseAND(F.lit(1)) == 1, F.col(c).cast("double"))
                .otherwise(F.lit(base[i])) for i, c in enumerate(features)]

    scores = F.transform(mask_arr, lambda m: scorer(mixed(m)))
    out = df.select(*(keep or []), *[F.col(c) for c in features if c not in (keep or [])],
                    scores.alias("_coalition_scores"))
    phis = {}
    for i, c in enumerate(features):
        ci = F.array(*[F.lit(float(v)) for v in coef[i]])
        phis[f"phi_{c}"] = F.aggregate(
            F.zip_with(F.col("_coalition_scores"), ci, lambda s, w: s * w), F.lit(0.0), lambda acc, v: acc + v)
    out = out.withColumns(phis)
    out = out.withColumn("score", scorer([F.col(c).cast("double") for c in features]))
    out = out.withColumn("base_score", scorer([F.lit(b) for b in base]))
    return out.drop("_coalition_scores")


def mean_abs(phis: DataFrame, features: list[str]) -> DataFrame:
    """``(feature, mean_abs)`` -- one global aggregate with a map-side partial step."""
    wide = phis.agg(*[F.avg(F.abs(F.col(f"phi_{c}"))).alias(c) for c in features])
    parts = ", ".join(f"'{c}', `{c}`" for c in features)
    return wide.selectExpr(f"stack({len(features)}, {parts}) AS (feature, mean_abs)")


def model_attributions(model, df: DataFrame, features: list[str], row_id: str,
                       baseline: list[float] | None = None, num_samples: int | None = None,
                       probability_col: str = "probability", seed: int = 42,
                       row_cap: int | None = None) -> DataFrame:
    """Per-row attributions for a fitted ``pyspark.ml`` classifier pipeline.

    ``model`` must accept the raw feature columns (e.g. a ``PipelineModel`` with
    a ``VectorAssembler`` first).  Each row is exploded into its coalitions
    (a generator, not a join), scored in one ``transform``, and the weighted
    scores are summed per ``row_id``.
    """
    from pyspark.ml.functions import vector_to_array

    df = _capped(df, row_cap, [row_id])
    p = len(features)
    base = column_means(df, features) if baseline is None else [float(b) for b in baseline]
    masks, coef = coalition_plan(p, num_samples, seed=seed)
    plan = F.array(*[F.struct(F.lit(int(m)).alias("m"),
                              F.array(*[F.lit(float(coef[i, k])) for i in range(p)]).alias("c"))
                     for k, m in enumerate(masks)])
    ex = df.select(row_id, *features).select(row_id, *features, F.explode(plan).alias("_k"))
    mixed = ex.select(
        row_id, F.col("_k.c").alias("_c"),
        *[F.when(F.shiftright(F.col("_k.m"), i).bitwiseAND(F.lit(1)) == 1, F.col(c).cast("double"))
          .otherwise(F.lit(base[i])).alias(c) for i, c in enumerate(features)])
    scored = model.transform(mixed).withColumn("_f", vector_to_array(F.col(probability_col))[1])
    return scored.groupBy(row_id).agg(
        *[F.sum(F.col("_f") * F.col("_c")[i]).alias(f"phi_{c}") for i, c in enumerate(features)])
