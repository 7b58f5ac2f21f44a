"""Gradient-boosted trees for several trials in shared passes over the data.

All training rows are binned once (bin edges are quantiles of the rows) and
written as blocks of small integers.  All trials then grow
their trees level by level together: one job per level, in which each
partition adds up the gradients and Hessians of its rows per (trial, node,
feature, bin); the partial histograms of a node are shuffled to one task, which
sums them in order of their partitions and picks the node's split.  The driver
gets splits only, a few numbers per node, however many rows, partitions,
features and bins there are; rows and their margins stay in the partitions.

Margins are updated once a tree and kept with their blocks; every
``CHECKPOINT_TREES`` trees they are written to the shared folder and read back,
so a lost executor replays a few trees, not all.

Second-order boosting with log loss: a leaf's value is
``-learning_rate * G / (H + L2)`` and a split's gain
``G_l^2/(H_l+L2) + G_r^2/(H_r+L2) - G^2/(H+L2)``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions.ensembles import Ensemble, Tree, matrix
from farebox.session import scratch_path

BINS = 32
L2 = 1.0
MIN_ROWS = 1          # rows a child must hold
MIN_GAIN = 1e-9
CHECKPOINT_TREES = 25
_NODES_A_TASK = 8     # nodes whose histograms one task sums and splits
_FAN_IN = 64          # partial histograms summed at once
_BLOCK_ROWS = 1 << 18  # rows of a block at most, so that a task's memory does not grow with the input
_CHUNK_ROWS = 1 << 15  # rows worked on at once (what they need stays in the processor's cache)
_JOINT_BINS = 1024    # features are counted together while their bins combine to so many cells at most,
_JOINT_CELLS = 1 << 15  # and to so many over all open nodes
_TIE = 1e-12          # gains this close (relative) are one: the first feature and bin wins


@dataclass(frozen=True)
class Trial:
    learning_rate: float
    max_depth: int
    n_trees: int


def bin_edges(df: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """Up to ``bins - 1`` split points per feature: quantiles of its values (one aggregate, mergeable sketches)."""
    share = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), share, 10_000).alias(f"q{i}")
                   for i, c in enumerate(features)]).first()
    return [sorted(set(row[i] or [])) for i in range(len(features))]


def _binned(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """(features, rows) bins of a (rows, features) matrix: bin k holds ``edges[k-1] < x <= edges[k]``, the last bin NaN too."""
    out = np.empty((len(edges), len(x)), np.uint8)
    for j, e in enumerate(edges):
        out[j] = np.where(np.isnan(x[:, j]), len(e), np.searchsorted(np.sort(np.array(e, float)), x[:, j]))
    return out


def _blocks(df: DataFrame, features: list[str], label: str, edges: list[list[float]]):
    """RDD of (bins, label) blocks of at most ``_BLOCK_ROWS`` rows, written first; nulls are binned as NaN."""
    names = [f"x{i}" for i in range(len(features))]

    def packed(batches):
        held, n = [], 0
        for batch in batches:
            y = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            bins = _binned(matrix(batch, tuple(names)), edges)
            while len(y):
                some = _BLOCK_ROWS - n
                held.append((bins[:, :some], y[:some]))
                n += len(held[-1][1])
                bins, y = bins[:, some:], y[some:]
                if n == _BLOCK_ROWS:
                    yield one(held)
                    held, n = [], 0
        if n:
            yield one(held)

    def one(held):
        bins, y = np.hstack([h[0] for h in held]), np.concatenate([h[1] for h in held]).astype(float)
        return pa.RecordBatch.from_arrays([pa.array([bins.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], names=["bins", "y"])

    def block(row):
        y = np.frombuffer(row[1])
        return np.frombuffer(row[0], np.uint8).reshape(len(features), len(y)), y

    path = scratch_path(df.sparkSession, "boost_rows")
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(x) for c, x in zip(features, names)], F.col(f"`{label}`").cast("double").alias("y"))
    rows.mapInArrow(packed, "bins binary, y binary").write.parquet(path)
    return df.sparkSession.read.schema("bins binary, y binary").parquet(path).rdd.map(block)


@dataclass
class _Growing:
    """A trial's tree under construction: open nodes of the current level and finished ones."""
    trial: Trial
    nodes: list[list]                     # [feature, bin, left, right, value, gain]
    open: list[int]

    @staticmethod
    def new(trial: Trial) -> _Growing:
        return _Growing(trial, [[-1, 0, 0, 0, 0.0, 0.0]], [0])


def _steps(nodes: list[list]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Depth of a tree, and feature, cut and left child per node; a leaf is its own left child and sends every row there."""
    depth, level = 0, [0]
    while level := [child for i in level if nodes[i][0] >= 0 for child in nodes[i][2:4]]:
        depth += 1
    inner = np.array([node[0] >= 0 for node in nodes])
    feature, cut, left = (np.array([node[k] for node in nodes], np.intp) for k in range(3))
    return depth, np.where(inner, feature, 0), np.where(inner, cut, 255).astype(np.uint8), np.where(inner, left, np.arange(len(nodes)))


def _descend(steps: tuple[int, np.ndarray, np.ndarray, np.ndarray], bins: np.ndarray) -> np.ndarray:
    """Node that each row of contiguous (features, rows) bins ends in; the right child is the left one's neighbour."""
    depth, feature, cut, left = steps
    flat, rows, first = bins.ravel(), np.arange(bins.shape[1]), feature * bins.shape[1]
    at = np.zeros(bins.shape[1], np.intp)
    for _ in range(depth):
        goes_right = flat.take(first.take(at) + rows) > cut.take(at)
        at = left.take(at) + goes_right
    return at


def _chunks(bins: np.ndarray, size: int) -> Iterator[tuple[slice, np.ndarray]]:
    for start in range(0, bins.shape[1], size):
        rows = slice(start, start + size)
        yield rows, np.ascontiguousarray(bins[:, rows])


def _moved(block, grown: list[list[list]]):
    """The block with each trial's margins moved by its new tree."""
    bins, y, margins = block
    margins = margins.copy()
    trees = [(_steps(nodes), np.array([node[4] for node in nodes])) for nodes in grown]
    for rows, part in _chunks(bins, _CHUNK_ROWS):
        for t, (steps, value) in enumerate(trees):
            margins[t, rows] += value.take(_descend(steps, part))
    return bins, y, margins


def _gradients(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1.0 / (1.0 + np.exp(-margin))
    return p - y, p * (1.0 - p)


def _together(widths: list[int], nodes: int) -> list[tuple[int, ...]]:
    """Features in runs whose bins combine to few cells: a run is counted in one pass over the rows."""
    most, runs = min(_JOINT_BINS, _JOINT_CELLS // nodes), []
    for j, w in enumerate(widths):
        if runs and math.prod(widths[i] for i in runs[-1]) * w <= most:
            runs[-1] += (j,)
        else:
            runs.append((j,))
    return runs


def _joint(part: np.ndarray, run: tuple[int, ...], widths: list[int]) -> np.ndarray:
    """Number of each row's combination of bins of the run's features."""
    code = part[run[0]].astype(np.intp)
    for j in run[1:]:
        code *= widths[j]
        code += part[j]
    return code


class _Counts:
    """Gradients, Hessians and rows of one trial's open nodes per combination of bins, for each run of features."""

    def __init__(self, nodes: list[list], opened: list[int], widths: list[int]):
        self.steps, self.widths, self.opened = _steps(nodes), widths, len(opened)
        self.place = np.full(len(nodes), len(opened), np.intp)  # rows of finished nodes count as one node more, left out at the end
        self.place[opened] = np.arange(len(opened))
        self.runs = _together(widths, len(opened) + 1)
        self.cells = [math.prod(widths[j] for j in run) for run in self.runs]
        self.sums = [np.zeros((3, (len(opened) + 1) * c)) for c in self.cells]

    def add(self, part: np.ndarray, codes: dict, margin: np.ndarray, y: np.ndarray) -> None:
        node = self.place.take(_descend(self.steps, part))
        g, h = _gradients(margin, y)
        for run, c, out in zip(self.runs, self.cells, self.sums):
            if run not in codes:
                codes[run] = _joint(part, run, self.widths)
            cell = node * c + codes[run]
            for k, weights in enumerate((g, h, None)):
                out[k] += np.bincount(cell, weights=weights, minlength=out.shape[1])

    def histograms(self) -> np.ndarray:
        """(open nodes, 3, features, bins)."""
        hist = np.zeros((self.opened, 3, len(self.widths), max(self.widths)))
        for run, out in zip(self.runs, self.sums):
            joint = out.reshape(3, self.opened + 1, *[self.widths[j] for j in run])[:, :-1]
            for axis, j in enumerate(run, 2):
                others = tuple(i for i in range(2, joint.ndim) if i != axis)
                hist[:, :, j, :self.widths[j]] = joint.sum(axis=others).swapaxes(0, 1)
        return hist


def _histograms(blocks, trees: list[tuple[list[list], list[int]]], widths: list[int]) -> Iterator[tuple]:
    """((trial, i), (3, features, bins)) over all blocks for each trial's i-th open node: gradients, Hessians and rows."""
    counts = {t: _Counts(nodes, opened, widths) for t, (nodes, opened) in enumerate(trees) if opened}
    size = max([_CHUNK_ROWS, *[out.shape[1] for c in counts.values() for out in c.sums]])
    some = False
    for bins, y, margins in blocks:
        some = True
        for rows, part in _chunks(bins, size):
            codes: dict = {}
            for t, c in counts.items():
                c.add(part, codes, margins[t, rows], y[rows])
    if some:
        yield from (((t, i), one) for t, c in counts.items() for i, one in enumerate(c.histograms()))


def _level_splits(state, asked: list[tuple[list[list], list[int]]], edges: list[list[float]]) -> dict:
    """{(trial, i): (sums of the node, its split or None)} for each trial's i-th open node, summed and chosen in tasks.

    Partial histograms are added in order of their partitions, so a run gives the same trees again.
    """
    parts = state.getNumPartitions()
    widths = [1 + len(e) for e in edges]
    tasks = -(-sum(len(opened) for _, opened in asked) // _NODES_A_TASK)
    tasks = max(1, min(tasks, max(parts, state.context.defaultParallelism)))

    def in_order(found):
        return reduce(np.add, [one for _, one in sorted(found, key=lambda x: x[0])])

    sums = state.mapPartitionsWithIndex(lambda number, blocks: (
        (key, (number, one)) for key, one in _histograms(blocks, asked, widths)))
    while parts > _FAN_IN:                  # first sums of neighbours, so that no task holds all partitions' histograms
        sums = (sums.map(lambda x: ((x[0], x[1][0] // _FAN_IN), x[1])).groupByKey(max(tasks, -(-parts // _FAN_IN)))
                .map(lambda x: (x[0][0], (x[0][1], in_order(x[1])))))
        parts = -(-parts // _FAN_IN)

    def choose(found):
        hist = in_order(found)
        best = best_split(hist, edges)
        return hist[:, 0, :].sum(axis=1).tolist(), best and (*best[:3], best[3].tolist(), best[4].tolist())

    return dict(sums.groupByKey(tasks).mapValues(choose).collect())


def best_split(hist: np.ndarray, edges: list[list[float]], min_rows: int = MIN_ROWS):
    """(feature, bin, gain, left sums, right sums) of a node's (3, features, bins) histogram, or None."""
    total = hist[:, 0, :].sum(axis=1)
    best = None
    for j, cuts in enumerate(edges):
        left = np.cumsum(hist[:, j, :len(cuts)], axis=1)
        right = total[:, None] - left
        ok = (left[2] >= min_rows) & (right[2] >= min_rows)
        gain = left[0] ** 2 / (left[1] + L2) + right[0] ** 2 / (right[1] + L2) - total[0] ** 2 / (total[1] + L2)
        gain = np.where(ok, gain, -np.inf)
        if not len(gain):
            continue
        k = int(np.flatnonzero(gain >= gain.max() - _TIE * abs(gain.max()))[0]) if np.isfinite(gain.max()) else 0
        if np.isfinite(gain[k]) and gain[k] > MIN_GAIN and (best is None or gain[k] > best[2] * (1 + _TIE)):
            best = (j, k, float(gain[k]), left[:, k], right[:, k])
    return best


def _leaf(sums: list[float], rate: float) -> float:
    return float(-rate * sums[0] / (sums[1] + L2))


def fit_trials(df: DataFrame, features: list[str], label: str, trials: list[Trial],
               edges: list[list[float]] | None = None) -> list[Ensemble]:
    """One ensemble per trial, all grown in the same passes over all rows of ``df``.

    Rows with a null label are left out; null and NaN features go right at
    every split.  ``edges`` (split points per feature) default to quantiles.
    """
    df = df.where(F.col(label).isNotNull())
    edges = bin_edges(df, features) if edges is None else edges
    if any(len(e) > 120 for e in edges):
        raise ValueError("at most 120 split points per feature")
    sc = df.sparkSession.sparkContext
    raw = _blocks(df, features, label, edges)
    rows, positive = raw.map(lambda b: np.array([len(b[1]), b[1].sum()])).fold(np.zeros(2), np.add)
    if not rows:
        raise ValueError("no training rows")
    rate = min(max(positive / rows, 1e-6), 1 - 1e-6)
    start = math.log(rate / (1 - rate))
    n_trials = len(trials)
    state = raw.map(lambda b: (b[0], b[1], np.full((n_trials, len(b[1])), start))).persist(StorageLevel.MEMORY_AND_DISK)
    done: list[list[list[list]]] = [[] for _ in trials]
    retired: list = []
    for number in range(max((t.n_trees for t in trials), default=0)):
        growing = [_Growing.new(t) if number < t.n_trees else _Growing(t, [[-1, 0, 0, 0, 0.0, 0.0]], []) for t in trials]
        for depth in range(max(t.max_depth for t in trials)):
            asked = [(g.nodes, g.open if depth < g.trial.max_depth else []) for g in growing]
            if not any(o for _, o in asked):
                break
            chosen = _level_splits(state, asked, edges)
            for t, (g, (_, opened)) in enumerate(zip(growing, asked)):
                fresh = []
                for i, node in enumerate(opened):
                    total, found = chosen[t, i]
                    if not depth:
                        g.nodes[node][4] = _leaf(total, g.trial.learning_rate)
                    if found is None:
                        continue
                    feature, cut, gain, left, right = found
                    g.nodes[node][:4] = [feature, cut, len(g.nodes), len(g.nodes) + 1]
                    g.nodes[node][5] = gain
                    for side in (left, right):
                        fresh.append(len(g.nodes))
                        g.nodes.append([-1, 0, 0, 0, _leaf(side, g.trial.learning_rate), 0.0])
                if opened:
                    g.open = fresh
        grown = [g.nodes for g in growing]
        for d, nodes, t in zip(done, grown, trials):
            if number < t.n_trees:
                d.append(nodes)
        last, state = state, state.map(lambda b, grown=grown: _moved(b, grown))
        if (number + 1) % CHECKPOINT_TREES == 0:
            path = scratch_path(df.sparkSession, "boost_margins")
            state.saveAsPickleFile(path, 1)
            state = sc.pickleFile(path)
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        retired.append(last)
        while len(retired) > 1:                 # the last margins are still read, by the first job of the next tree
            retired.pop(0).unpersist()
    for old in [*retired, state]:
        old.unpersist()

    def tree(nodes: list[list]) -> Tree:
        return Tree(tuple(n[0] for n in nodes), tuple(float(edges[n[0]][n[1]]) if n[0] >= 0 else 0.0 for n in nodes),
                    tuple(n[2] for n in nodes), tuple(n[3] for n in nodes), tuple(n[4] for n in nodes), tuple(n[5] for n in nodes))

    return [Ensemble(tuple(features), tuple(tree(n) for n in d), start, 1.0) for d in done]

