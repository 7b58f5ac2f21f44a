"""Tree ensembles as plain arrays: scoring and path conditions without the ML runtime.

An ensemble is a list of complete or ragged binary trees over named features.
A row goes left where ``x <= threshold``; null and NaN go right.  It comes from
a fitted ``pyspark.ml`` GBT (:func:`from_gbt`), from
:mod:`farebox.operators.boost`, or is written by hand.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tree:
    """Nodes by index, root 0: ``feature[i] < 0`` marks a leaf of value ``value[i]``; ``gain[i]`` is its split's, where known."""
    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    value: tuple[float, ...]
    gain: tuple[float, ...] = ()

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf index per row of a (rows, features) matrix."""
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right = np.array(self.left), np.array(self.right)
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            goes_left = x[rows, np.maximum(f, 0)] <= threshold[at]
            at = np.where(inner, np.where(goes_left, left[at], right[at]), at)

    def leaves(self) -> list[tuple[float, dict[int, tuple[float, float]]]]:
        """(value, {feature: (low, high]}) per leaf; a feature met twice keeps the tighter interval."""
        out, stack = [], [(0, {})]
        while stack:
            i, box = stack.pop()
            f = self.feature[i]
            if f < 0:
                out.append((self.value[i], box))
                continue
            low, high = box.get(f, (-math.inf, math.inf))
            t = self.threshold[i]
            stack.append((self.left[i], {**box, f: (low, min(high, t))}))
            stack.append((self.right[i], {**box, f: (max(low, t), high)}))
        return out


@dataclass(frozen=True)
class Ensemble:
    """``margin = start + sum(tree values)``; ``P(label = 1) = 1 / (1 + exp(-scale * margin))``."""
    features: tuple[str, ...]
    trees: tuple[Tree, ...]
    start: float = 0.0
    scale: float = 1.0

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += np.array(tree.value)[tree.leaf_of(x)]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.scale * self.margins(x)))

    def importances(self) -> list[float]:
        """Share of each feature in the gains of all splits (zeros where there is no split)."""
        sums = [0.0] * len(self.features)
        for tree in self.trees:
            for f, g in zip(tree.feature, tree.gain):
                if f >= 0:
                    sums[f] += g
        return [v / (sum(sums) or 1.0) for v in sums]

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "start": self.start, "scale": self.scale,
                           "trees": [[t.feature, t.threshold, t.left, t.right, t.value, t.gain] for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> Ensemble:
        d = json.loads(text)
        trees = tuple(Tree(*(tuple(column) for column in t)) for t in d["trees"])
        return Ensemble(tuple(d["features"]), trees, d["start"], d["scale"])


def matrix(batch: pa.RecordBatch, features: tuple[str, ...]) -> np.ndarray:
    """(rows, features) doubles of an Arrow batch, nulls as NaN."""
    columns = [batch.column(batch.schema.get_field_index(c)).cast(pa.float64(), safe=False) for c in features]
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns]) if columns else np.zeros((batch.num_rows, 0))


def score(ensemble: Ensemble, df: DataFrame, out: str = "score", margin: bool = False) -> DataFrame:
    """``df`` with P(label = 1) (or the margin) per row, by Arrow batches."""
    schema = df.drop(out).withColumn(out, F.lit(0.0)).schema
    shared = df.sparkSession.sparkContext.broadcast(ensemble)
    kept = [c for c in df.columns if c != out]

    def run(batches):
        for batch in batches:
            x = matrix(batch, shared.value.features)
            got = shared.value.margins(x) if margin else shared.value.probabilities(x)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(got)], names=[*kept, out])

    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def score_all(ensembles: list[Ensemble], df: DataFrame, keep: list[str]) -> DataFrame:
    """(model, keep columns, score): every row scored by every ensemble (numbered from 0) in one pass."""
    shared = df.sparkSession.sparkContext.broadcast(ensembles)
    names = list(dict.fromkeys(c for e in ensembles for c in e.features))
    schema = df.select(*[F.col(f"`{c}`") for c in keep], F.array(F.lit(0.0)).alias("scores")).schema

    def run(batches):
        for batch in batches:
            got = np.column_stack([e.probabilities(matrix(batch, e.features)) for e in shared.value])
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(got), pa.list_(pa.float64()))], names=[*keep, "scores"])

    needed = list(dict.fromkeys([*keep, *names]))
    scored = df.select(*[F.col(f"`{c}`") for c in needed]).mapInArrow(run, schema)
    return scored.select(*[F.col(f"`{c}`") for c in keep], F.posexplode("scores").alias("model", "score"))


def from_gbt(model) -> Ensemble:
    """A fitted ``pyspark.ml`` GBT classifier (or a pipeline that ends in one): log loss, ``scale`` 2."""
    from farebox.functions.trees import gbt_parts

    gbt, names = gbt_parts(model)

    def flat(root, weight: float) -> Tree:
        rows: list[list] = []

        def add(node) -> int:
            at = len(rows)
            rows.append([-1, 0.0, 0, 0, weight * float(node.prediction())])
            if node.getClass().getSimpleName() != "LeafNode":
                split = node.split()
                if split.getClass().getSimpleName() != "ContinuousSplit":
                    raise NotImplementedError("categorical splits are not read")
                rows[at][:2] = [int(split.featureIndex()), float(split.threshold())]
                rows[at][2] = add(node.leftChild())
                rows[at][3] = add(node.rightChild())
            return at

        add(root)
        return Tree(*(tuple(column) for column in zip(*rows)))

    trees = tuple(flat(t._java_obj.rootNode(), float(w)) for t, w in zip(gbt.trees, gbt.treeWeights))
    names = names or [f"f{i}" for i in range(gbt.numFeatures)]
    return Ensemble(tuple(names), trees, 0.0, 2.0)
