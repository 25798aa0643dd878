import random

import numpy as np
import pytest

from mixcast.functions.quantiles import exact_quantiles, order_statistics


def _df(spark, values, parts=4, groups=None):
    rows = [(g, v) for g, v in zip(groups or ["a"] * len(values), values)]
    return spark.createDataFrame(rows, "g string, x double").repartition(parts)


@pytest.mark.parametrize("small", [10, 50000])
def test_matches_linear_interpolation(spark, small):
    rnd = random.Random(3)
    vals = [rnd.uniform(-50, 50) for _ in range(3000)] + [None] * 10
    df = _df(spark, vals)
    probs = [0.0, 0.1, 0.25, 1 / 3, 0.5, 2 / 3, 0.9, 1.0]
    got = exact_quantiles(df, ["x"], probs, small=small)
    ref = np.quantile(np.array([v for v in vals if v is not None]), probs)
    for p, r in zip(probs, ref):
        assert got[((), "x", p)] == pytest.approx(r, rel=1e-12, abs=1e-12)


def test_hot_value_holding_a_third(spark):
    rnd = random.Random(5)
    vals = [7.0] * 2000 + [rnd.uniform(0, 100) for _ in range(4000)]
    df = _df(spark, vals)
    probs = [0.2, 0.34, 0.5, 0.66, 0.8]
    got = exact_quantiles(df, ["x"], probs, small=20)
    ref = np.quantile(np.array(vals), probs)
    for p, r in zip(probs, ref):
        assert got[((), "x", p)] == pytest.approx(r, rel=1e-12)


def test_grouped_and_partition_invariant(spark):
    rnd = random.Random(9)
    groups = [rnd.choice(["a", "b", "c", None]) for _ in range(4000)]
    vals = [round(rnd.gauss(0, 10), 2) for _ in range(4000)]
    probs = [0.25, 0.5, 0.75]
    one = exact_quantiles(_df(spark, vals, 1, groups), ["x"], probs, by=["g"], small=15)
    many = exact_quantiles(_df(spark, vals, 16, groups), ["x"], probs, by=["g"], small=15)
    assert one == many
    for g in ["a", "b", "c", None]:
        sel = np.array([v for v, gg in zip(vals, groups) if gg == g])
        for p, r in zip(probs, np.quantile(sel, probs)):
            assert one[((g,), "x", p)] == pytest.approx(r, rel=1e-12, abs=1e-12)


def test_order_statistics_ranks(spark):
    vals = [float(v) for v in range(100, 0, -1)]
    df = _df(spark, vals)
    got = order_statistics(df, ["x"], lambda g, c, n: [0, 5, 99], small=5)
    assert got[((), "x", 0)] == 1.0 and got[((), "x", 5)] == 6.0 and got[((), "x", 99)] == 100.0


def test_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5])[((), "x", 0.5)] is None


@pytest.mark.parametrize("accuracy", [20, 10000])
def test_per_column_probs_and_coarse_sketch(spark, accuracy):
    """Different quantiles per column in one selection; a coarse sketch (many misses) still exact."""
    rnd = random.Random(11)
    rows = [(rnd.uniform(0, 10), float(rnd.randint(0, 5)) if i % 3 else None) for i in range(5000)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(6)
    probs = {"a": [0.5], "b": [1 / 3, 2 / 3, 0.9]}
    got = exact_quantiles(df, ["a", "b"], probs, accuracy=accuracy, small=40)
    for c, i in (("a", 0), ("b", 1)):
        sel = np.array([r[i] for r in rows if r[i] is not None])
        for p, r in zip(probs[c], np.quantile(sel, probs[c])):
            assert got[((), c, p)] == pytest.approx(r, rel=1e-12, abs=1e-12)


def test_grouped_bucket_passes_match_joined(spark):
    """Both grouped strategies give the same exact values (many targets per group)."""
    from mixcast.functions import quantiles as Q
    rnd = random.Random(13)
    groups = [rnd.choice(["a", "b"]) for _ in range(3000)]
    vals = [round(rnd.uniform(0, 50), 1) for _ in range(3000)]
    probs = [i / 20 for i in range(21)]
    df = _df(spark, vals, 4, groups)
    old = (Q.GROUP_CELLS, Q.GROUP_FANOUT)
    try:
        Q.GROUP_CELLS, Q.GROUP_FANOUT = 64, 0
        bucket = exact_quantiles(df, ["x"], probs, by=["g"], small=30)
        Q.GROUP_CELLS = 0
        joined = exact_quantiles(df, ["x"], probs, by=["g"], small=30)
    finally:
        Q.GROUP_CELLS, Q.GROUP_FANOUT = old
    assert bucket == joined
    for g in ["a", "b"]:
        sel = np.array([v for v, gg in zip(vals, groups) if gg == g])
        for p, r in zip(probs, np.quantile(sel, probs)):
            assert bucket[((g,), "x", p)] == pytest.approx(r, rel=1e-12, abs=1e-12)
