"""Path-dependent Tree SHAP for Spark tree ensembles (forest or boosting regressors), by batches of rows.

The fitted ensemble is saved to the shared folder and its trees read back as a table
(tree, node, prediction, rawCount, children, split) - bounded by the model size.  Every leaf becomes a path: for
each feature on the way to it an interval (low, high] and the share of training rows that its splits sent on
(Lundberg, Erion and Lee, 2018: training counts stand for the features not conditioned on).  Against a leaf, a row
matters only by which of the path's intervals hold it, so a leaf of u features has at most 2^u different rows; the
Shapley sums of all leaves and patterns of a tree are worked out at once from products of (share + held t), and a
batch of rows looks its patterns up.  Output is long (key, feature, shap_value, base_value) over the encoded model
features; base + sum(shap) equals the ensemble prediction.
"""

from __future__ import annotations

import math
import os
import uuid

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import rnd
from ..schema import KEY
from ..session import scratch_path
from .features import feature_names

CELLS = 1 << 18  # rows x leaves x features held at once

def tree_tables(model, spark) -> tuple[list[dict], list[float]]:
    """Trees of the last pipeline stage as arrays, and the weight of each tree."""
    root = scratch_path(spark, f"trees-{uuid.uuid4().hex}")
    model.model.write().overwrite().save(root)
    stage = model.model.stages[-1]
    d = os.path.join(root, "stages", f"{len(model.model.stages) - 1}_{stage.uid}")
    nodes = spark.read.parquet(os.path.join(d, "data")).select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount", "nodeData.leftChild",
        "nodeData.rightChild", F.col("nodeData.split.featureIndex").alias("feature"),
        F.get(F.col("nodeData.split.leftCategoriesOrThreshold"), 0).alias("threshold")).collect()
    meta = spark.read.parquet(os.path.join(d, "treesMetadata")).collect()
    weights = {r[0]: float(r[2]) for r in meta}
    n_trees = len(weights)
    if "RandomForest" in type(stage).__name__:  # a forest averages its trees
        weights = {t: 1.0 / n_trees for t in weights}
    trees, by_tree = [], {}
    for r in nodes:
        by_tree.setdefault(r["treeID"], []).append(r)
    for t in sorted(weights):
        rows = by_tree[t]
        n = max(r["id"] for r in rows) + 1
        tr = {k: np.zeros(n, dtype=float) for k in ("value", "cover", "threshold")}
        tr.update({k: np.full(n, -1, dtype=np.int64) for k in ("left", "right", "feature")})
        for r in rows:
            i = r["id"]
            tr["value"][i], tr["cover"][i] = r["prediction"], float(r["rawCount"])
            tr["left"][i], tr["right"][i] = r["leftChild"], r["rightChild"]
            if r["leftChild"] >= 0:
                tr["feature"][i], tr["threshold"][i] = r["feature"], r["threshold"]
        trees.append(tr)
    return trees, [weights[t] for t in sorted(weights)]


def expected_value(tree: dict) -> float:
    """Cover-weighted mean of the leaf values (the prediction with no feature known)."""
    leaves = tree["left"] < 0
    return float((tree["value"][leaves] * tree["cover"][leaves]).sum() / tree["cover"][0])


def leaf_paths(tree: dict) -> list[dict]:
    """The leaves by number of features on their path: ``feature``, ``low``, ``high``, ``share`` (leaf, u) and ``value``."""
    found: dict[int, list] = {}
    todo = [(0, {})]
    while todo:
        j, path = todo.pop()
        if tree["left"][j] < 0:
            found.setdefault(len(path), []).append((tree["value"][j], path))
            continue
        f, cut = int(tree["feature"][j]), tree["threshold"][j]
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        for child, own in ((tree["left"][j], (low, min(high, cut))), (tree["right"][j], (max(low, cut), high))):
            todo.append((child, path | {f: (*own, share * tree["cover"][child] / tree["cover"][j])}))
    out = []
    for u, leaves in sorted(found.items()):
        if u:  # a tree without splits adds nothing to any feature
            ends = np.array([[p[f] for f in p] for _, p in leaves])
            out.append({"feature": np.array([list(p) for _, p in leaves]), "low": ends[:, :, 0], "high": ends[:, :, 1],
                        "share": ends[:, :, 2], "value": np.array([v for v, _ in leaves])})
    return out


def pattern_table(share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """(leaf, pattern, u): the attribution of each path feature for each set of intervals that hold the row.

    For feature i it is value (held_i - share_i) times the sum over sets S of the others of |S|! (u - |S| - 1)! / u!
    times held over S and share outside S: the coefficients of the product of (share_j + held_j t).
    """
    n, u = share.shape
    held = (np.arange(1 << u)[:, None] >> np.arange(u)) & 1
    weight = [math.factorial(s) * math.factorial(u - s - 1) / math.factorial(u) for s in range(u)]
    out = np.empty((n, 1 << u, u))
    for i in range(u):
        poly = np.zeros((u, n, 1 << u))
        poly[0] = 1.0
        for d, j in enumerate(k for k in range(u) if k != i):
            for s in range(d + 1, 0, -1):
                poly[s] = poly[s] * share[:, j, None] + poly[s - 1] * held[:, j]
            poly[0] *= share[:, j, None]
        total = sum(w * p for w, p in zip(weight, poly))
        out[:, :, i] = value[:, None] * (held[:, i] - share[:, i, None]) * total
    return out


def batch_shap(paths: list[list[dict]], weights: list[float], x: np.ndarray) -> np.ndarray:
    """Attributions (row, feature) of the rows ``x`` (Spark sends x <= threshold left)."""
    phi = np.zeros(x.shape)
    for tree, w in zip(paths, weights):
        for g in tree:
            n, u = g["feature"].shape
            table = pattern_table(g["share"], g["value"] * w)
            step = max(1, CELLS // (n * u))
            columns = [np.flatnonzero(g["feature"].ravel() == f) for f in range(x.shape[1])]
            for at in range(0, len(x), step):
                some = x[at:at + step][:, g["feature"]]
                code = ((some > g["low"]) & (some <= g["high"])) @ (1 << np.arange(u))
                part = table[np.arange(n), code].reshape(len(some), n * u)
                for f, c in enumerate(columns):
                    if len(c):
                        phi[at:at + step, f] += part[:, c].sum(axis=1)
    return phi


def shap_tree(model, rows: DataFrame, key: str = KEY) -> DataFrame:
    """Tree SHAP of every row of ``rows`` for a fitted forest / boosting pipeline."""
    spark = rows.sparkSession
    trees, weights = tree_tables(model, spark)
    base = float(sum(w * expected_value(t) for t, w in zip(trees, weights)))
    names = feature_names()
    prep = PipelineModel(stages=model.model.stages[:-1]).transform(rows)
    feats = prep.select(key, vector_to_array("features").alias("__x"))
    b = spark.sparkContext.broadcast(([leaf_paths(t) for t in trees], weights))  # bounded by the model

    def explain(batches):
        for pdf in batches:
            if len(pdf):
                phi = batch_shap(*b.value, np.stack(pdf["__x"].to_numpy()).astype(float))
                yield pd.DataFrame({key: np.repeat(pdf[key].to_numpy(), len(names)), "feature": names * len(pdf),
                                    "shap_value": phi[:, :len(names)].ravel()})

    schema = f"{key} long, feature string, shap_value double"
    return feats.mapInPandas(explain, schema).select(key, "feature", rnd("shap_value").alias("shap_value"),
                                                     rnd(F.lit(base)).alias("base_value"))
