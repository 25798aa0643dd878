"""Tree SHAP: additivity, and equality with the path-dependent Shapley values by brute force."""
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixcast.operators import train as TR
from mixcast.operators import treeshap as TS
from mixcast.operators.treeshap import expected_value, shap_tree

RAW = "campaign_id long, TV double, Radio double, Social_Media double, Influencer string, Sales double"


def _cond_exp(tree, x, known, j=0):
    """E[f | x_S] with unknown features split by training counts (the path-dependent value)."""
    if tree["left"][j] < 0:
        return tree["value"][j]
    f, l_, r_ = tree["feature"][j], tree["left"][j], tree["right"][j]
    if f in known:
        return _cond_exp(tree, x, known, l_ if x[f] <= tree["threshold"][j] else r_)
    c = tree["cover"]
    return (c[l_] * _cond_exp(tree, x, known, l_) + c[r_] * _cond_exp(tree, x, known, r_)) / c[j]


def test_tree_shap_matches_brute_force():
    # a small hand-made tree over 3 features with repeated use of feature 0
    tree = {"left": np.array([1, 3, 5, -1, -1, -1, -1]), "right": np.array([2, 4, 6, -1, -1, -1, -1]),
            "feature": np.array([0, 1, 0, -1, -1, -1, -1]), "threshold": np.array([0.5, 0.3, 0.8, 0, 0, 0, 0.]),
            "value": np.array([0, 0, 0, 1.0, 3.0, -2.0, 7.0]), "cover": np.array([100, 60, 40, 25, 35, 10, 30.])}
    m = 3
    for x in [np.array([0.2, 0.1, 9.0]), np.array([0.9, 0.5, 0.0]), np.array([0.6, 0.9, 1.0])]:
        phi = TS.batch_shap([TS.leaf_paths(tree)], [1.0], np.array([x]))[0]
        for i in range(m):
            others = [k for k in range(m) if k != i]
            exact = 0.0
            for s in range(m):
                for S in itertools.combinations(others, s):
                    w = math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m)
                    exact += w * (_cond_exp(tree, x, set(S) | {i}) - _cond_exp(tree, x, set(S)))
            assert phi[i] == pytest.approx(exact, abs=1e-12)
        assert expected_value(tree) + phi[:m].sum() == pytest.approx(_cond_exp(tree, x, {0, 1, 2}))


def grown(rng, m, depth):
    """A random tree; features come again along a path."""
    nodes = []

    def add(level, cover):
        j = len(nodes)
        nodes.append({"left": -1, "right": -1, "feature": -1, "threshold": 0.0, "value": rng.normal(), "cover": cover})
        if level and cover > 3 and rng.random() < 0.9:
            share = int(rng.integers(1, cover))
            nodes[j] |= {"feature": int(rng.integers(m)), "threshold": rng.normal()}
            nodes[j] |= {"left": add(level - 1, share), "right": add(level - 1, cover - share)}
        return j

    add(depth, 500)
    return {k: np.array([n[k] for n in nodes]) for k in nodes[0]}


def test_batches_match_brute_force_on_random_trees(monkeypatch):
    monkeypatch.setattr(TS, "CELLS", 50)  # many small steps
    rng, m = np.random.default_rng(6), 4
    trees = [grown(rng, m, d) for d in (0, 1, 3, 6, 7)]
    weights = [0.5, 1.0, 2.0, -1.0, 0.1]
    x = rng.normal(size=(12, m))
    got = TS.batch_shap([TS.leaf_paths(t) for t in trees], weights, x)
    for row, phi in zip(x, got):
        for i in range(m):
            exact = 0.0
            for s in range(m):
                for S in itertools.combinations([k for k in range(m) if k != i], s):
                    w = math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m)
                    exact += w * sum(c * (_cond_exp(t, row, set(S) | {i}) - _cond_exp(t, row, set(S))) for t, c in zip(trees, weights))
            assert phi[i] == pytest.approx(exact, abs=1e-10)


def test_shap_tree_additive_on_spark_models(spark):
    rows = [(i, float(i % 97), float((i * 7) % 41), float((i * 3) % 13), ["Mega", "Macro", "Micro", "Nano"][i % 4],
             3.0 * (i % 97) + (i * 7) % 41 + 0.5 * ((i * 3) % 13) + (i % 5)) for i in range(400)]
    df = spark.createDataFrame(rows, RAW)
    for name in ["Gradient Boosting", "Random Forest"]:
        est = TR.regression_estimators("quick")[name].copy({})
        if name == "Random Forest":
            est = est.setNumTrees(5).setMaxDepth(4)
        m, _ = TR.fit_model(df, est, "regression")
        sub = df.where("campaign_id < 25")
        sh = shap_tree(m, sub).groupBy("campaign_id").agg(F.sum("shap_value").alias("s"), F.first("base_value").alias("b"))
        pred = {r["campaign_id"]: r["prediction"] for r in m.predict(sub).collect()}
        for r in sh.collect():
            assert r["s"] + r["b"] == pytest.approx(pred[r["campaign_id"]], abs=1e-4)
