"""Shapley values of tree ensembles in closed form (M17, A8), without copies of rows.

Against one baseline row, a leaf's path splits into features that only the row
satisfies (R), only the baseline satisfies (B), both, or neither.  A coalition
S reaches the leaf exactly when R is in S, B is not, and no feature is
satisfied by neither.  The leaf's value v therefore gives each feature of R
``v (|R|-1)! |B|! / (|R|+|B|)!`` and each of B ``-v |R|! (|B|-1)! / (|R|+|B|)!``.

Since the baseline is fixed, a leaf with k path features has 2^k cases, whose
values are tabulated once per ensemble on the driver (bounded by the ensemble).
Rows then look their cases up in Arrow batches: one pass, no join, no explode,
no shuffle, and the cost per row is the number of leaves, whatever the number
of features.

* ``attributions``: of the margin (additive over trees), any number of features.
* ``probability_attributions``: of ``P(label = 1)``, which is not additive:
  the same leaf cases give the margin of all 2^p coalitions by one subset-sum
  transform per row, for at most ``MAX_PROBABILITY_FEATURES`` features used.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions.ensembles import Ensemble, matrix
from farebox.operators.explain import exact_coefficients

MAX_PROBABILITY_FEATURES = 12
_ROWS = 2048   # rows worked on together


class LeafCases:
    """Per leaf: its path features and intervals, which of them the baseline satisfies, and the cases' values."""

    def __init__(self, ensemble: Ensemble, baseline: list[float]):
        if len(baseline) != len(ensemble.features):
            raise ValueError(f"{len(baseline)} baseline values for {len(ensemble.features)} features")
        self.n = len(ensemble.features)
        base = np.array([math.nan if b is None else float(b) for b in baseline])
        self.leaves = []
        for tree in ensemble.trees:
            for value, box in tree.leaves():
                features = sorted(box)
                bounds = [box[f] for f in features]
                base_ok = [bool(satisfied(base[f], *b)) for f, b in zip(features, bounds)]
                self.leaves.append((value, np.array(features, np.int64), bounds, base_ok))
        self.base_margin = float(ensemble.margins(base[None, :])[0])

    def shares(self, value: float, base_ok: list[bool]) -> np.ndarray:
        """(2^k, k): each path feature's share for every set of features that the row satisfies."""
        k = len(base_ok)
        out = np.zeros((1 << k, k))
        for case in range(1 << k):
            row_ok = [case >> j & 1 == 1 for j in range(k)]
            if any(not r and not b for r, b in zip(row_ok, base_ok)):
                continue
            only_row = sum(r and not b for r, b in zip(row_ok, base_ok))
            only_base = sum(b and not r for r, b in zip(row_ok, base_ok))
            whole = math.factorial(only_row + only_base)
            for j in range(k):
                if row_ok[j] and not base_ok[j]:
                    out[case, j] = value * math.factorial(only_row - 1) * math.factorial(only_base) / whole
                elif base_ok[j] and not row_ok[j]:
                    out[case, j] = -value * math.factorial(only_row) * math.factorial(only_base - 1) / whole
        return out

    def terms(self, value: float, base_ok: list[bool], bits: list[int]) -> list[list[tuple[int, float]]]:
        """Per case: (feature set, coefficient) whose sums over subsets give the leaf's part of each coalition's margin."""
        k, out = len(base_ok), []
        for case in range(1 << k):
            row_ok = [case >> j & 1 == 1 for j in range(k)]
            if any(not r and not b for r, b in zip(row_ok, base_ok)):
                out.append([])
                continue
            need = sum(1 << bits[j] for j in range(k) if row_ok[j] and not base_ok[j])
            without = [bits[j] for j in range(k) if base_ok[j] and not row_ok[j]]
            out.append([(need | sum(1 << b for b in some), (-1) ** size * value)
                        for size in range(len(without) + 1) for some in combinations(without, size)])
        return out


def satisfied(x, low: float, high: float):
    """``low < x <= high`` as the tree decides it: null and NaN go right at every split."""
    return ~(x <= low) & ((x <= high) if high < math.inf else True)


def _cases(x: np.ndarray, features: np.ndarray, bounds) -> np.ndarray:
    case = np.zeros(len(x), np.int64)
    for j, (f, (low, high)) in enumerate(zip(features, bounds)):
        case |= satisfied(x[:, f], low, high).astype(np.int64) << j
    return case


def _mapped(df: DataFrame, ensemble: Ensemble, keep: list[str], names: list[str], values) -> DataFrame:
    """``keep`` columns and the double columns ``names`` = ``values(x)`` of every row."""
    schema = df.select(*[F.col(f"`{c}`") for c in keep], *[F.lit(0.0).alias(n) for n in names]).schema
    features = ensemble.features

    def run(batches):
        for batch in batches:
            x = matrix(batch, features)
            got = np.concatenate([values(x[at:at + _ROWS]) for at in range(0, len(x), _ROWS)]) if len(x) else np.zeros((0, len(names)))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(np.ascontiguousarray(got[:, i])) for i in range(len(names))]],
                                             names=[*keep, *names])

    needed = list(dict.fromkeys([*keep, *features]))
    return df.select(*[F.col(f"`{c}`") for c in needed]).mapInArrow(run, schema)


def attributions(df: DataFrame, ensemble: Ensemble, baseline: list[float], keep: list[str]) -> DataFrame:
    """Per row: ``keep``, ``phi_<feature>`` of the margin, ``margin`` and ``base_margin`` (the phis add up to their difference)."""
    cases = LeafCases(ensemble, baseline)
    tables = [(f, b, cases.shares(v, ok)) for v, f, b, ok in cases.leaves if len(f)]
    shared = df.sparkSession.sparkContext.broadcast((tables, cases.n, cases.base_margin))

    def values(x):
        tables, n, base = shared.value
        phi = np.zeros((len(x), n))
        for features, bounds, shares in tables:
            phi[:, features] += shares[_cases(x, features, bounds)]
        margin = base + phi.sum(axis=1)
        return np.column_stack([phi, margin, np.full(len(x), base)])

    return _mapped(df, ensemble, keep, [*(f"phi_{c}" for c in ensemble.features), "margin", "base_margin"], values)


def probability_attributions(df: DataFrame, ensemble: Ensemble, baseline: list[float], keep: list[str]) -> DataFrame:
    """As :func:`attributions`, of ``P(label = 1)``: exact over all coalitions of the features the ensemble splits on."""
    used = sorted({f for t in ensemble.trees for f in t.feature if f >= 0})
    if len(used) > MAX_PROBABILITY_FEATURES:
        raise ValueError(f"{len(used)} features in splits, at most {MAX_PROBABILITY_FEATURES}; explain the margin instead")
    cases = LeafCases(ensemble, baseline)
    bit = {f: i for i, f in enumerate(used)}
    tables = []
    for v, f, b, ok in cases.leaves:
        per_case = cases.terms(v, ok, [bit[int(i)] for i in f])
        width = max(map(len, per_case))
        sets = np.array([[s for s, _ in t] + [0] * (width - len(t)) for t in per_case], np.int64).reshape(len(per_case), width)
        parts = np.array([[c for _, c in t] + [0.0] * (width - len(t)) for t in per_case]).reshape(len(per_case), width)
        tables.append((f, b, sets, parts))
    coef = exact_coefficients(len(used))[1] if used else np.zeros((0, 1))
    shared = df.sparkSession.sparkContext.broadcast((tables, coef))
    n, p, start, scale = cases.n, len(used), ensemble.start, ensemble.scale

    def values(x):
        tables, coef = shared.value
        sums = np.zeros((len(x), 1 << p))
        rows = np.arange(len(x))
        for features, bounds, sets, parts in tables:
            case = _cases(x, features, bounds)
            for j in range(sets.shape[1]):
                sums[rows, sets[case, j]] += parts[case, j]
        for i in range(p):                              # sums over subsets, one feature at a time
            part = sums.reshape(len(x), -1, 2, 1 << i)
            part[:, :, 1, :] += part[:, :, 0, :]
        score = 1.0 / (1.0 + np.exp(-scale * (start + sums)))
        phi = np.zeros((len(x), n))
        phi[:, used] = score @ coef.T
        return np.column_stack([phi, score[:, -1], score[:, 0]])

    return _mapped(df, ensemble, keep, [*(f"phi_{c}" for c in ensemble.features), "score", "base_score"], values)
