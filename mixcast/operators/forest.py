"""K2/K5: random forests grown level by level over blocks of bins (``boosting.blocks_of``).

Spark's forest walks every row through all trees from their roots and adds it to histograms of all their nodes, far
apart in memory: about a microsecond per row, tree and level, and every partition ships the histograms of all nodes.
Here rows are dealt by their bins (``boosting._cells``): a tree tells cells (one bin of every feature) apart, not rows.
Where all cells together are few (``boosting.WHOLE``), the rows are read once: every tree's copies are added up by cell,
and a task that holds a tree's sums grows the whole tree in memory.  What is shuffled is trees x cells, whatever the rows.

With more cells a task takes one tree after another over its blocks, so that a tree's histograms stay in the cache; they
are added up by tree over all tasks, and the task that holds a tree's sums picks its splits: one job per level, on a
partition per core.  Either way only splits and node totals reach the driver.

The rules are those of ``RandomForestRegressor`` / ``RandomForestClassifier``: features in at most ``BINS`` quantile
bins, a Poisson(1) number of copies of every row per tree, variance or Gini reduction of weighted rows, at least
``minInstancesPerNode`` copies on either side, a draw of features per node, leaves of one prediction merged.  Copies
are drawn by a hash of the row's key, so they do not depend on partitions.  The result is Spark's own model class,
read from its saved form.
"""

from __future__ import annotations

import json
import math
import os
import time
import uuid

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import KEY
from ..session import scratch_path
from . import boosting
from .boosting import _cells, _draw, _width, blocks_of, joined

CHUNK = 131_072  # rows that a task adds up at once, about
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])  # chance of at most k copies
_ROW = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,"
        "gain:double,leftChild:int,rightChild:int,"
        "split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


def copies(u: np.ndarray, seed: int, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows in a tree's sample and how often each stands there: Poisson(1) by hash."""
    draw = _draw(u, seed * 1_000_003 + tree)
    rows = np.flatnonzero(draw >= _POISSON[0])
    return rows, np.searchsorted(_POISSON, draw[rows], side="right").astype(float)


def _add(rows: list[dict], tree: int, feature: np.ndarray, cut: np.ndarray, level: int, starts: np.ndarray, classes: int,
         seed: int, split: bool) -> np.ndarray:
    """A tree's sums over some blocks for the nodes of a level: (copies, then target sums) by node, and by node and bin."""
    width, base, cells = 1 << level, (1 << level) - 1, int(starts[-1])
    sums = max(1, classes)
    nodes = np.zeros((2 + sums, width))  # copies, sums, squares
    bins_ = np.zeros((1 + sums, width * cells))
    for row in rows:
        pick, w = copies(row["u"], seed, tree)
        flat, at, n = row["bins"].ravel(), np.zeros(len(pick), np.int64), len(row["y"])
        for _ in range(level):
            f = feature.take(at)
            if f.size and f.min() < 0:  # rows in leaves above
                inner = f >= 0
                f, at, pick, w = f[inner], at[inner], pick[inner], w[inner]
            at = 2 * at + 1 + (flat.take(f * n + pick) > cut.take(at))
        node, y = at - base, row["y"].take(pick)
        if classes:
            kind = y.astype(np.int64)
            value, place = w * row["w"].take(pick), kind * width + node
        else:
            value, place = w * y, node
            nodes[-1] += np.bincount(node, weights=value * y, minlength=width)
        nodes[0] += np.bincount(node, weights=w, minlength=width)
        nodes[1:1 + sums] += np.bincount(place, weights=value, minlength=width * sums).reshape(sums, width)
        if split:
            node, place = node * cells, place * cells
            for j in range(len(starts) - 1):
                b = row["bins"][j].take(pick) + starts[j]
                bins_[0] += np.bincount(node + b, weights=w, minlength=width * cells)
                bins_[1:] += np.bincount(place + b, weights=value, minlength=sums * width * cells).reshape(sums, -1)
    return np.concatenate([nodes.ravel(), bins_.ravel()]) if split else nodes.ravel()


def best_splits(hist: np.ndarray, starts: np.ndarray, least: int, allowed: np.ndarray, classes: int):
    """(feature, last bin of the left side, gain) of every node: the first of the largest impurity reductions."""
    width, m = hist.shape[1], len(starts) - 1
    best = np.full(width, -np.inf)
    feature, cut = np.full(width, -1, np.int64), np.zeros(width, np.int64)
    whole = hist[:, :, starts[0]:starts[1]].sum(axis=2)
    size = whole[1:].sum(axis=0) if classes else whole[0]
    scale = 1e-12 * np.maximum(1e-300, (whole[1:] ** 2).sum(axis=0) / np.where(size > 0, size, 1.0) ** 2)
    for j in range(m):
        left = hist[:, :, starts[j]:starts[j + 1]].cumsum(axis=2)[:, :, :-1]
        if not left.shape[2]:
            continue
        right = whole[:, :, None] - left
        nl, nr = (left[1:].sum(axis=0), right[1:].sum(axis=0)) if classes else (left[0], right[0])
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = ((left[1:] ** 2).sum(axis=0) / nl + (right[1:] ** 2).sum(axis=0) / nr
                    - ((whole[1:] ** 2).sum(axis=0) / size)[:, None]) / size[:, None]
        gain[(left[0] < least) | (right[0] < least) | ~np.isfinite(gain)] = -np.inf
        at = gain.argmax(axis=1)
        top = gain[np.arange(width), at]
        better = (top > best) & (top > scale) & allowed[:, j]
        best[better], feature[better], cut[better] = top[better], j, at[better]
    return feature, cut, best


def grow(blocks, edges: list[np.ndarray], trees: int, depth: int, least: int, features: int, classes: int, seed: int):
    """Trees as arrays (tree, node of a complete binary tree): split feature (-1: none), last left bin, gain, node totals."""
    sc = blocks.context
    m = len(edges)
    starts = np.concatenate([[0], np.cumsum([len(e) + 1 for e in edges])]).astype(np.int64)
    sums, cells, size = max(1, classes), int(starts[-1]), (1 << depth + 1) - 1
    feature, cut = np.full((trees, size), -1, np.int64), np.zeros((trees, size), np.int64)
    gain, totals = np.zeros((trees, size)), np.zeros((trees, 2 + sums, size))
    parts = min(trees, sc.defaultParallelism)
    for level in range(depth + 1):
        width, base, split = 1 << level, (1 << level) - 1, level < depth
        sent = sc.broadcast((feature[:, :base], cut[:, :base]))

        def local(rows):
            rows = _chunks(rows)
            f, c = sent.value
            for t in range(trees if rows else 0):
                yield t, _add(rows, t, f[t], c[t], level, starts, classes, seed, split)

        def picked(found):
            total: dict[int, np.ndarray] = {}
            for t, v in found:
                total[t] = total[t] + v if t in total else v
            for t, v in total.items():
                nodes = v[:(2 + sums) * width].reshape(2 + sums, width)
                if not split:
                    yield t, nodes, None
                    continue
                allowed = _allowed(seed, t, level, m, features)
                yield t, nodes, best_splits(v[nodes.size:].reshape(1 + sums, width, cells), starts, least, allowed, classes)

        for t, nodes, best in blocks.mapPartitions(local).partitionBy(parts).mapPartitions(picked).collect():
            totals[t, :, base:base + width] = nodes
            if best is not None:
                feature[t, base:base + width], cut[t, base:base + width], gain[t, base:base + width] = best
        sent.unpersist()
        if not (feature[:, base:base + width] >= 0).any():
            break
    return feature, cut, gain, totals


def _allowed(seed: int, tree: int, level: int, m: int, features: int) -> np.ndarray:
    """(node, feature): whether a node of a level may split on a feature."""
    if features >= m:
        return np.ones((1 << level, m), bool)
    draws = np.random.default_rng([seed & 0xFFFFFFFF, tree, level]).random((1 << level, m))
    return draws.argsort(axis=1).argsort(axis=1) < features


class _Kinds:
    """Rows of a cell by their class."""

    def __init__(self, classes: int):
        self.classes = classes

    def of(self, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        return y.astype(np.int64) if self.classes else np.zeros(len(y), np.int64)


def _sampled(cells: dict, tree: int, classes: int, seed: int) -> np.ndarray:
    """A tree's sums by cell: copies, then the weights of each class; or copies, sums and squares of the target."""
    width, kinds = _width(cells), max(1, classes)
    total = np.zeros((1 + kinds if classes else 3, width))
    for a in range(0, len(cells["u"]), CHUNK):
        own = slice(a, a + CHUNK)
        pick, w = copies(cells["u"][own], seed, tree)
        slot, y = cells["slot"][own].take(pick), cells["y"][own].take(pick)
        if not len(slot):
            continue
        low, high = int(slot[0]), int(slot[-1]) + 1  # rows lie in the order of their slots

        def add(values):
            found = np.bincount(slot - low, weights=values, minlength=high - low)
            out = np.zeros(kinds * width)
            out[low:high] = found
            return out.reshape(kinds, width)

        if classes:
            total[0] += add(w).sum(axis=0)
            total[1:] += add(w if cells["w"] is None else w * cells["w"][own].take(pick))
        else:
            for power, part in enumerate((w, w * y, w * y * y)):
                total[power, low:high] += np.bincount(slot - low, weights=part, minlength=high - low)
    return total


def _tree(sums: np.ndarray, bins: np.ndarray, starts: np.ndarray, tree: int, depth: int, least: int, features: int, classes: int,
          seed: int) -> tuple[np.ndarray, ...]:
    """Split feature, last left bin, gain and totals of the nodes of one tree, grown over its sums by cell."""
    m, size, kinds, width = len(starts) - 1, (1 << depth + 1) - 1, max(1, classes), int(starts[-1])
    feature, cut, gain, totals = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size), np.zeros((2 + kinds, size))
    live = np.flatnonzero(sums[0] > 0)
    sums, bins, at = sums[:, live], bins[:, live].astype(np.int64), np.zeros(len(live), np.int64)
    for level in range(depth + 1):
        nodes, base = 1 << level, (1 << level) - 1
        node = at - base
        for k, v in enumerate(sums):
            totals[k, base:base + nodes] = np.bincount(node, weights=v, minlength=nodes)
        if level == depth:
            break
        hist = np.empty((1 + kinds, nodes, width))
        for j in range(m):
            n = int(starts[j + 1] - starts[j])
            place = node * n + bins[j]
            for k in range(1 + kinds):
                hist[k, :, starts[j]:starts[j + 1]] = np.bincount(place, weights=sums[k], minlength=nodes * n).reshape(nodes, n)
        best = best_splits(hist, starts, least, _allowed(seed, tree, level, m, features), classes)
        feature[base:base + nodes], cut[base:base + nodes], gain[base:base + nodes] = best
        f = feature.take(at)
        inner = f >= 0
        if not inner.any():
            break
        if not inner.all():  # cells in leaves are done
            f, at, sums, bins = f[inner], at[inner], sums[:, inner], bins[:, inner]
        at = 2 * at + 1 + (bins[f, np.arange(len(f))] > cut.take(at))
    return feature, cut, gain, totals


def grow_by_tree(cells, edges: list[np.ndarray], trees: int, depth: int, least: int, features: int, classes: int, seed: int):
    """``grow`` over few cells: one job that reads the rows once, adds up every tree's copies by cell and grows it in a task."""
    starts = np.concatenate([[0], np.cumsum([len(e) + 1 for e in edges])]).astype(np.int64)
    bins = cells.context.broadcast(joined(cells.map(lambda c: (c["id"], c["bins"])).collect(), 1))

    def local(found):
        for c in found:
            for t in range(trees):
                yield t, (c["id"], _sampled(c, t, classes, seed))

    def grown(found):
        parts: dict[int, list] = {}
        for t, part in found:
            parts.setdefault(t, []).append(part)
        for t in list(parts):
            yield t, *_tree(joined(parts.pop(t), 1), bins.value, starts, t, depth, least, features, classes, seed)

    found = sorted(cells.mapPartitions(local).partitionBy(trees, int).mapPartitions(grown).collect(), key=lambda one: one[0])
    bins.unpersist()
    return tuple(np.stack(part) for part in list(zip(*found))[1:])


def tree_rows(feature, cut, gain, totals, edges: list[np.ndarray], classes: int) -> list[tuple]:
    """A tree's nodes, numbered from the root with every left branch first, as Spark saves them."""
    def told(i):
        s = totals[1:1 + max(1, classes), i]
        return float(s.argmax()) if classes else float(s[0] / totals[0, i])

    leaf = feature < 0
    for i in range(len(feature) - 1, -1, -1):  # leaves of one prediction are merged
        if not leaf[i] and leaf[2 * i + 1] and leaf[2 * i + 2] and told(2 * i + 1) == told(2 * i + 2):
            leaf[i] = True
    out: list[tuple] = []

    def put(i):
        at = len(out)
        out.append(None)
        n, s = totals[0, i], totals[1:1 + max(1, classes), i]
        if classes:
            stats, impurity = s.tolist(), 1.0 - float((s ** 2).sum() / s.sum() ** 2)
        else:
            stats, impurity = [float(n), float(s[0]), float(totals[-1, i])], max(0.0, float(totals[-1, i] / n - (s[0] / n) ** 2))
        left = right = -1
        if not leaf[i]:
            left = put(2 * i + 1)
            right = put(2 * i + 2)
        cond = (-1, [], -1) if leaf[i] else (int(feature[i]), [float(edges[feature[i]][cut[i]])], -1)
        out[at] = (at, told(i), impurity, stats, int(n), -1.0 if leaf[i] else float(gain[i]), left, right, cond)
        return at

    put(0)
    return out


def fit_forest(data: DataFrame, est):
    """The fitted model of a ``RandomForestRegressor`` / ``RandomForestClassifier`` with the estimator's settings."""
    spark = data.sparkSession
    clf = isinstance(est, RandomForestClassifier)
    weight = est.getWeightCol() if est.isDefined("weightCol") else None
    blocks, edges = blocks_of(data.withColumn("fold", F.lit(-1)), est.getLabelCol(), "fold", KEY, est.getFeaturesCol(), weight,
                              spark.sparkContext.defaultParallelism)
    ready = blocks.map(_arrays)
    top = ready.map(lambda r: r["y"].max()).fold(-1.0, max)
    classes = int(top) + 1 if clf else 0
    m, trees = len(edges), est.getNumTrees()
    subset = {"all": m, "sqrt": math.ceil(math.sqrt(m)), "onethird": math.ceil(m / 3)}[est.getFeatureSubsetStrategy()]
    settings = (edges, trees, est.getMaxDepth(), est.getMinInstancesPerNode(), subset, classes, est.getSeed())
    cells = _cells(blocks, _Kinds(classes)).persist(StorageLevel.MEMORY_AND_DISK)
    grown = grow_by_tree(cells, *settings) if 0 < cells.map(_width).sum() <= boosting.WHOLE else grow(ready, *settings)
    cells.unpersist()
    blocks.unpersist()
    rows = spark.sparkContext.parallelize([(t, [a[t] for a in grown]) for t in range(trees)], min(trees, 16)).flatMap(
        lambda one: [(one[0], node) for node in tree_rows(*one[1], edges, classes)])
    return _spark_model(spark, est, rows, m, classes)


def _arrays(row: dict) -> dict:
    n = row["n"]
    return {"bins": np.frombuffer(row["bins"], np.uint8).reshape(-1, n), "y": np.frombuffer(row["y"]),
            "u": np.frombuffer(row["u"], np.uint64), "w": np.frombuffer(row["w"]) if row["w"] else np.ones(n)}


def _chunks(rows) -> list[dict]:
    """Blocks put together, so that a tree's histograms are made anew for fewer, larger pieces."""
    out, held = [], []
    for row in [*rows, None]:
        if row is not None:
            held.append(row)
        if held and (row is None or sum(len(r["y"]) for r in held) >= CHUNK):
            out.append({k: np.concatenate([r[k] for r in held], axis=-1) for k in held[0]})
            held = []
    return out


def _spark_model(spark, est, rows, m: int, classes: int):
    """The trees of a forest as Spark's model."""
    cls = RandomForestClassificationModel if classes else RandomForestRegressionModel
    return saved_model(spark, est, cls, rows, m, [1.0] * est.getNumTrees(), classes, classes)


def saved_model(spark, est, cls, rows, m: int, weights: list[float], classes: int, tree_classes: int):
    """Trees with their weights as Spark's model ``cls``, written in its saved form and loaded."""
    kind = "classification" if classes else "regression"
    tree = "classification.DecisionTreeClassificationModel" if tree_classes else "regression.DecisionTreeRegressionModel"
    root = scratch_path(spark, f"trees-{uuid.uuid4().hex}")
    given = {p.name: v for p, v in est._paramMap.items()}
    usual = {p.name: v for p, v in est._defaultParamMap.items()}
    base = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    whole = base | {"class": f"org.apache.spark.ml.{kind}.{cls.__name__}", "uid": f"{est.uid}_{uuid.uuid4().hex[:12]}",
                    "paramMap": given, "defaultParamMap": usual, "numFeatures": m, "numTrees": len(weights)}
    if classes:
        whole["numClasses"] = classes
    of_tree = {"maxDepth", "minInstancesPerNode", "seed", "featuresCol", "labelCol", "weightCol", "maxBins", "impurity"}
    each = base | {"class": f"org.apache.spark.ml.{tree}", "paramMap": {k: v for k, v in given.items() if k in of_tree},
                   "defaultParamMap": {k: v for k, v in usual.items() if k in of_tree}}
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(os.path.join(root, "metadata"))
    spark.createDataFrame([(t, json.dumps(each | {"uid": f"dt_{uuid.uuid4().hex[:12]}"}), w) for t, w in enumerate(weights)],
                          "_1 int, _2 string, _3 double").write.parquet(os.path.join(root, "treesMetadata"))
    spark.createDataFrame(rows, _ROW, verifySchema=False).write.parquet(os.path.join(root, "data"))
    return cls.load(root)
