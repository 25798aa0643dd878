"""Robust LOWESS against a direct computation that weighs every row at every point."""
import numpy as np
import pytest

from mixcast.operators import lowess as L
from mixcast.schema import CHANNELS

SCHEMA = "campaign_id long, TV double, Radio double, Social_Media double, Influencer string, Sales double"


def direct(x, y, points, frac, passes):
    n, g = len(x), x.min() + np.arange(points) * ((x.max() - x.min()) / (points - 1))
    k = max(1, int(np.floor(frac * n + 1e-10)))
    robust, out = np.ones(n), None
    for p in range(passes + 1):
        out = []
        for c in g:
            d = np.abs(x - c)
            h = np.sort(d)[k - 1]
            if h == 0:
                out.append((np.nan, 0, 0.0))
                continue
            w = np.where(d < h, (1 - (d / h) ** 3) ** 3, 0) * robust
            u = (x - c) / h
            sw, sx, sy, sxx, sxy = w.sum(), (w * u).sum(), (w * y).sum(), (w * u * u).sum(), (w * u * y).sum()
            den = sw * sxx - sx * sx
            v = (sy * sxx - sx * sxy) / den if den > 1e-9 * sw * sxx else (sy / sw if sw > 0 else np.nan)
            out.append((v, int((d < h).sum()), h))
        if p < passes:
            level = np.array([o[0] for o in out])
            at = (x - g[0]) / ((x.max() - x.min()) / (points - 1))
            j = np.minimum(np.floor(at), points - 2).astype(int)
            e = np.abs(y - (level[j] + (at - j) * (level[j + 1] - level[j])))
            m = np.median(e[~np.isnan(e)]) if (~np.isnan(e)).any() else 0
            robust = np.where(np.isnan(e) | (m == 0), 1.0, np.where(e < 6 * m, (1 - (e / (6 * m or 1)) ** 2) ** 2, 0))
    return g, out


def check(spark, rows, points=12, frac=2 / 3, passes=3):
    got = L.lowess_curve(spark.createDataFrame(rows, SCHEMA), points, frac, passes).collect()
    by = {(r.channel, r.j): r for r in got}
    for i, ch in enumerate(CHANNELS):
        pairs = [(r[1 + i], r[5] / r[1 + i]) for r in rows if r[1 + i] and r[5] is not None]
        x, y = (np.array(v, float) for v in zip(*pairs))
        if x.min() == x.max():
            assert (ch, 0) not in by
            continue
        g, want = direct(x, y, points, frac, passes)
        for j, (v, n, h) in enumerate(want):
            r = by[ch, j]
            assert r.x == pytest.approx(g[j], abs=1e-6) and r.bandwidth == pytest.approx(h, abs=1e-6) and r.n_used == n
            assert (r.roi_fit is None) if np.isnan(v) else r.roi_fit == pytest.approx(v, abs=2e-4)
    return by


@pytest.mark.parametrize("shell", [20_000, 5])
def test_curve_equals_direct_fits(spark, monkeypatch, shell):
    monkeypatch.setattr(L, "SHELL", shell)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        tv, radio = float(rng.gamma(2, 30) + 1), 40.0 if i % 3 == 0 else float(rng.uniform(1, 90))  # a hot budget
        sales = tv * (2 + np.sin(tv / 40)) * (30 if i % 25 == 0 else 1) + rng.normal()  # outliers
        rows.append((i, tv, radio, 5.0, "Mega", float(sales)))
    rows += [(1000, 0.0, None, 5.0, "Mega", 3.0), (1001, 4.0, 3.0, 0.0, "Nano", None)]
    robust, plain = check(spark, rows), check(spark, rows, passes=0)
    assert abs(robust["TV", 5].roi_fit - 2) < abs(plain["TV", 5].roi_fit - 2)  # outliers weigh little


def test_most_rows_of_one_budget(spark):
    rows = [(i, 10.0 if i % 10 else 10.0 + i, 1.0 + i, 2.0, "Mega", 20.0 + i) for i in range(200)]
    by = check(spark, rows, points=7)
    assert by["TV", 0].bandwidth == 0 and by["TV", 0].roi_fit is None


def test_line_is_kept(spark):
    rows = [(i, 1.0 + i, 1.0, 1.0, "Mega", (1.0 + i) * (2.0 + 0.5 * (1.0 + i))) for i in range(200)]
    for r in check(spark, rows, points=5).values():
        assert r.roi_fit == pytest.approx(2.0 + 0.5 * r.x, abs=1e-3)


def test_empty_table(spark):
    assert L.lowess_curve(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("shell", [20_000, 3])
def test_ranks_are_exact_and_buckets_are_few(spark, monkeypatch, shell):
    monkeypatch.setattr(L, "SHELL", shell)
    rng = np.random.default_rng(7)
    v = np.concatenate([rng.gamma(2, 50, 4000), np.full(3000, 12.5), np.zeros(40), rng.uniform(0, 1e-12, 30), [1e300]])
    rng.shuffle(v)
    blocks = spark.sparkContext.parallelize([("TV", part, part) for part in np.array_split(v, 7)], 4)
    asked = [0, 39, 40, 70, 2000, 3500, 5000, len(v) - 1]
    got = L.order_statistics(blocks, lambda b, keys: [("k", b[1])] if "k" in keys else [], lambda key, n: asked)
    for r in asked:
        want = np.sort(v)[r]
        assert got["k", r] == (want, int((v < want).sum()))
    # a count leaves a task as sums by bucket, as many for ten times the rows
    handed = [sum(len(codes) for _, (codes, _) in L._counted(lambda b, keys: [("k", b[1])], {"k": [(0, 63, L.FIRST)]}, [("TV", w, w)]))
              for w in (v, np.tile(v, 10))]
    assert handed[0] == handed[1] < 1000


def test_rows_reach_python_as_few_blocks(spark):
    rows = [(i, 1.0 + i, 0.0, None, "Mega", 3.0 if i % 2 else None) for i in range(5000)]
    blocks = L.blocks_of(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    assert [(ch, len(x), len(y)) for ch, x, y in blocks] == [("TV", 2500, 2500)]
