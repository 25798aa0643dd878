import itertools
import random

import numpy as np
import pytest

from mixcast.operators import evaluate as EV

PRED = "campaign_id long, model string, split string, actual string, predicted string, " \
       "score_Low double, score_Medium double, score_High double"


def _auc_brute(y, s):
    pos = [v for a, v in zip(y, s) if a]
    neg = [v for a, v in zip(y, s) if not a]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_with_ties_equals_brute_force(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(300):
        a = rnd.choice(["Low", "Medium", "High"])
        rows.append((i, "m", "test", a, a, float(rnd.randint(0, 5)), float(rnd.randint(0, 5)), float(rnd.randint(0, 5))))
    df = spark.createDataFrame(rows, PRED)
    got = EV.roc_auc_ovr(df).first()["roc_auc"]
    total, acc = 0, 0.0
    for j, c in enumerate(["Low", "Medium", "High"]):
        y = [r[3] == c for r in rows]
        s = [r[5 + j] for r in rows]
        acc += _auc_brute(y, s) * sum(y)
        total += sum(y)
    assert got == pytest.approx(acc / total, abs=1e-6)


def test_missing_class_zero_division_and_label_union(spark):
    rows = [(1, "m", "test", "Low", "Low", 0, 0, 0), (2, "m", "test", "Low", "Medium", 0, 0, 0),
            (3, "m", "test", "High", "Low", 0, 0, 0), (4, "m", "test", "High", "High", 0, 0, 0)]
    df = spark.createDataFrame([(a, b, c, d, e, float(f), float(g), float(h)) for a, b, c, d, e, f, g, h in rows], PRED)
    m = EV.classification_metrics(df).first()
    # Low: p=1/2 r=1/2; High: p=1 r=1/2; Medium: support 0 (weight 0)
    assert m["accuracy"] == 0.5
    assert m["precision"] == pytest.approx(0.75) and m["recall"] == pytest.approx(0.5)
    assert m["f1"] == pytest.approx((0.5 * 2 + (2 / 3) * 2) / 4, abs=1e-6)
    cm = EV.confusion_matrix(df).collect()
    assert len(cm) == 9 and sum(r["n"] for r in cm) == 4
    assert EV.roc_auc_ovr(df).first()["roc_auc"] is None  # Medium has no positives


def test_regression_metrics_match_numpy(spark):
    rnd = random.Random(2)
    y = np.array([rnd.uniform(0, 100) for _ in range(500)])
    p = y + np.array([rnd.gauss(0, 5) for _ in range(500)])
    df = spark.createDataFrame([(i, "m", "test", float(a), float(b)) for i, (a, b) in enumerate(zip(y, p))],
                               "campaign_id long, model string, split string, actual double, predicted double")
    m = EV.regression_metrics(df, digits=12).first()
    assert m["mae"] == pytest.approx(np.mean(np.abs(y - p)), rel=1e-9)
    assert m["rmse"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2)), rel=1e-9)
    assert m["r2"] == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2), rel=1e-9)


def test_eco_score_rules(spark):
    runs = spark.createDataFrame([("a", 0.0, "low", 10), ("b", 2.0, "high", 1000), ("c", 2.0, "high", 1000),
                                  ("d", 1.0, "moderate", 50)],
                                 "model string, train_time_s double, complexity string, n_params long")
    out = {r["model"]: r for r in EV.eco_score(runs).collect()}
    assert out["a"]["eco_score"] == 10.0 and out["a"]["advice"] == "favour"
    assert out["b"]["eco_score"] == 0.0 and out["b"]["advice"] == "limit"
    assert out["d"]["eco_score"] == 5.0 and out["d"]["advice"] == "acceptable"
    zero = spark.createDataFrame([("a", 0.0, "low", 10)], "model string, train_time_s double, complexity string, n_params long")
    assert EV.eco_score(zero).first()["eco_score"] == 10.0


def test_auc_bucketed_equals_single_window(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(2000):
        a = rnd.choice(["Low", "Medium", "High"])
        rows.append((i, "m", "test", a, a, round(rnd.gauss(0, 1), 3), round(rnd.gauss(0, 1), 3), round(rnd.gauss(0, 1), 3)))
    df = spark.createDataFrame(rows, PRED)
    one = EV.roc_auc_ovr(df).first()["roc_auc"]
    many = EV.roc_auc_ovr(df, bucket_rows=50).first()["roc_auc"]
    assert one == many
