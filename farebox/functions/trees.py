"""Fitted tree ensembles as column expressions.

A ``pyspark.ml`` GBT classifier is a weighted sum of regression trees over the
assembled feature vector.  Each tree becomes a nested ``CASE WHEN x <= t``
expression over the named feature columns, so the model can be evaluated
inside whole-stage codegen, also inside higher-order functions (the Shapley
coalitions of :mod:`farebox.operators.explain`) -- no vector assembly, no
model UDF, no explode.

Split semantics follow the fitted model: a continuous split sends a row left
when ``x <= threshold``; null or NaN go right (the comparison is not true).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column
from pyspark.sql import functions as F


def _node_expr(node, xs: list[Column]) -> Column:
    """Expression of one JVM tree node (recursive over the fitted tree, depth <= maxDepth)."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    if split.getClass().getSimpleName() != "ContinuousSplit":
        raise NotImplementedError("categorical splits are not compiled; assemble features without category metadata")
    x = xs[int(split.featureIndex())]
    return F.when(x <= F.lit(float(split.threshold())), _node_expr(node.leftChild(), xs)) \
        .otherwise(_node_expr(node.rightChild(), xs))


def gbt_parts(model) -> tuple[GBTClassificationModel, list[str] | None]:
    """The GBT stage and the assembler's input columns (feature order) of a model or pipeline."""
    if isinstance(model, PipelineModel):
        gbt = next(s for s in reversed(model.stages) if isinstance(s, GBTClassificationModel))
        asm = next((s for s in model.stages if isinstance(s, VectorAssembler)), None)
        return gbt, (asm.getInputCols() if asm is not None else None)
    return model, None


# Compiled expressions grow with the node count; beyond this use
# ``explain.model_attributions`` / ``model.transform`` instead.
MAX_COMPILED_NODES = 50_000


def gbt_margin(model: GBTClassificationModel, xs: list[Column]) -> Column:
    """``sum_i w_i * tree_i(x)``."""
    nodes = sum(int(t.numNodes) for t in model.trees)
    if nodes > MAX_COMPILED_NODES:
        raise ValueError(f"ensemble has {nodes} nodes (> {MAX_COMPILED_NODES}); score it with model.transform")
    margin = F.lit(0.0)
    for tree, w in zip(model.trees, model.treeWeights):
        margin = margin + F.lit(float(w)) * _node_expr(tree._java_obj.rootNode(), xs)
    return margin


def gbt_probability_scorer(model):
    """Scorer ``[feature columns] -> P(label = 1)`` equal to the model's probability[1].

    Binary GBT uses log loss: ``p = 1 / (1 + exp(-2 * margin))``.
    """
    gbt, _ = gbt_parts(model)

    def score(xs: list[Column]) -> Column:
        xd = [x.cast("double") for x in xs]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * gbt_margin(gbt, xd)))
    return score


def gbt_feature_order(model, default: list[str]) -> list[str]:
    _, cols = gbt_parts(model)
    return list(cols) if cols else list(default)
