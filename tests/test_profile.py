import collections
import random

import pytest

from mixcast.operators import prepare as PR
from mixcast.operators import profile as P

RAW = "campaign_id long, TV double, Radio double, Social_Media double, Influencer string, Sales double"


def _camp(spark, rows):
    df = spark.createDataFrame(rows, RAW)
    return PR.with_roi_shares(PR.with_total_budget(df))


def test_dropped_decile_edges_and_not_calculable(spark):
    # TV has 3 distinct values -> fewer bins; Social_Media constant -> one edge -> "not calculable"
    rows = [(i, float(1 + i % 3), float(1 + i), 2.0, "Mega", 10.0 + i) for i in range(60)]
    camp = _camp(spark, rows)
    curve = P.saturation_curve(camp)
    tv_bins = sorted(r["bin"] for r in curve.where("channel = 'TV'").collect())
    assert tv_bins == [1, 2]  # edges {1, 2, 3}: bins (1,2] incl. 1, (2,3]
    pts = {r["channel"]: r for r in P.saturation_points(camp).collect()}
    assert pts["Social_Media"]["status"] == "not calculable" and pts["Social_Media"]["peak_roi"] is None


def test_saturation_first_bin_rule_and_after_peak(spark):
    # channel ROI low in the first bin, peak later, then a drop
    rows = []
    for i in range(100):
        tv = 1.0 + i
        roi = 5.0 if i < 10 else (20.0 if i < 50 else 10.0)
        rows.append((i, tv, 1.0, 1.0, "Mega", roi * tv))
    camp = _camp(spark, rows)
    first = {r["channel"]: r for r in P.saturation_points(camp).collect()}["TV"]
    assert first["status"] == "detected" and first["saturation_budget"] == pytest.approx(5.5)
    after = {r["channel"]: r for r in P.saturation_points(camp, after_peak=True).collect()}["TV"]
    assert after["saturation_budget"] > 50


def test_uncorrelated_gives_typed_empty_report(spark):
    rows = [(i, float((i * 7919) % 101), float((i * 104729) % 97), float((i * 31) % 89), "Mega", float((i * 17) % 83))
            for i in range(200)]
    camp = _camp(spark, rows)
    out = P.collinear_pairs(camp, cols=["TV", "Radio", "Social_Media", "Sales"])
    assert out.count() == 0
    assert out.columns == ["variable_1", "variable_2", "r", "level", "risk"]


def test_quasi_constant_threshold_is_strict(spark):
    rows = [(i, 1.0 if i < 96 else 2.0 + i, 1.0 if i < 95 else 3.0 + i, 1.0, "Mega", 1.0) for i in range(100)]
    out = {r["variable"]: r for r in P.quasi_constant(spark.createDataFrame(rows, RAW), cols=["TV", "Radio"]).collect()}
    assert out["TV"]["frequency"] == 0.96 and out["TV"]["quasi_constant"] is True
    assert out["Radio"]["frequency"] == 0.95 and out["Radio"]["quasi_constant"] is False


def test_histogram_last_bin_closed_and_zero_filled(spark):
    rows = [(i, v, 1.0, 1.0, "Mega", 1.0) for i, v in enumerate([0.0, 0.0, 10.0, 10.0, 10.0])]
    h = {r["bin"]: r["n"] for r in P.histogram(spark.createDataFrame(rows, RAW), ["TV"], bins=4).collect()}
    assert h == {0: 2, 1: 0, 2: 0, 3: 3}


def test_box_stats_whiskers(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 9, 100]
    rows = [(i, 1.0, 1.0, 1.0, "Mega", float(v)) for i, v in enumerate(vals)]
    r = P.box_stats(spark.createDataFrame(rows, RAW)).first()
    assert r["q1"] == 3.25 and r["q3"] == 7.75 and r["whisker_high"] == 9.0 and r["n_fliers"] == 1


def test_outlier_flags_match_report_counts(spark):
    # TV 1..8 and one 100: q1 = 3, q3 = 7, fences -3 / 13 -> only the 100 is flagged
    rows = [(i, float(i), 1.0, 1.0, "Mega", 5.0) for i in range(1, 9)] + [(9, 100.0, 1.0, 1.0, "Mega", 5.0)]
    camp = _camp(spark, rows)
    flags = {r["campaign_id"]: r["TV_outlier"] for r in P.flag_outliers(camp, ["TV"]).collect()}
    assert [k for k, v in flags.items() if v] == [9]
    rep = {r["variable"]: r for r in P.iqr_outliers(camp, ["TV"]).collect()}["TV"]
    assert rep["n_outliers"] == 1 and rep["q1"] == 3.0 and rep["q3"] == 7.0 and rep["upper"] == 13.0


def _by_counting(rows, cols):
    out = {}
    for c in cols:
        counts = collections.Counter(r[c] + 0.0 for r in rows if r[c] is not None)
        if counts:
            value, n = min(counts.items(), key=lambda kv: (-kv[1], kv[0]))
            out[c] = (value, n, sum(counts.values()))
    return out


def test_dominant_values_equal_plain_counting(spark):
    rng = random.Random(7)
    rows = []
    for i in range(30_000):
        rows.append({"hot": 0.0 if i % 3 else rng.random(),                   # proven by the summary
                     "two": [5.0, -5.0][i % 2],                               # a tie: the smaller value
                     "zeros": [0.0, -0.0, 1.0][i % 3],                        # zeros of both signs are one value
                     "rare": 7.0 if i % 1500 == 0 else float(i),              # 20 of 30,000: must be counted in full
                     "distinct": float(30_000 - i),
                     "steps": float(rng.randrange(40)),                       # more values near the top than are listed
                     "sparse": 3.0 if i == 17 else None, "none": None})
    cols = list(rows[0])
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(16)
    want = _by_counting(rows, cols)
    got = {r["variable"]: r for r in P.quasi_constant(df, cols).collect()}
    assert set(got) == set(want)
    for c, (value, n, total) in want.items():
        assert (got[c]["dominant_value"], got[c]["frequency"]) == (value, pytest.approx(n / total, abs=5e-5)), c
        assert got[c]["quasi_constant"] == (n / total > 0.95), c
    flagged = P.quasi_constant_columns(df, cols, 0.5)
    assert {r["variable"] for r in flagged.collect()} == {c for c, (_, n, total) in want.items() if n / total > 0.5}


def test_proven_columns_shuffle_no_rows(spark):
    df = spark.range(20_000).selectExpr("if(id % 10 < 9, 1D, cast(id as double)) as TV", "cast(id as double) as Radio")
    listed, totals = P.frequent_values(df, ["TV", "Radio"])
    assert totals == {"TV": 20_000, "Radio": 20_000}
    assert listed["TV"][0][0] == 1.0 and 18_000 <= listed["TV"][0][1] <= 18_000 + P.SUMMARY_ERROR * 20_000
    plan = P.quasi_constant(df, ["TV"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    empty = df.where("TV < 0")
    assert P.quasi_constant(empty, ["TV"]).count() == 0 and P.quasi_constant_columns(empty, ["TV"]).count() == 0


def test_rare_values_are_counted_in_tasks_of_bounded_size(spark, monkeypatch):
    """No task counts the values of its input partition: rows are dealt by value first, into tasks that do not grow."""
    monkeypatch.setattr(P, "COUNTED", 2_000)
    df = spark.range(0, 20_000, 1, 1).selectExpr("cast(id % 9000 as double) as TV", "if(id < 8, if(id < 4, -0D, 0D), id) as Radio")
    out = P.quasi_constant(df, ["TV", "Radio"])
    got = {r["variable"]: (r["dominant_value"], r["frequency"]) for r in out.collect()}
    assert got == {"TV": (0.0, 0.0001), "Radio": (0.0, 0.0004)}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.index("hashpartitioning(part") > plan.rindex("count(1)")  # below every count


def test_saturation_reports_share_the_edges(spark, monkeypatch):
    from mixcast.functions import quantiles as Q

    rows = [(i, 1.0 + i, 2.0 * i, 5.0, "Mega", 30.0 + i % 7) for i in range(100)]
    df = spark.createDataFrame(rows, "campaign_id long, TV double, Radio double, Social_Media double, Influencer string, Sales double")
    runs, exact = [], Q.exact_quantiles
    monkeypatch.setattr(Q, "exact_quantiles", lambda *a, **kw: runs.append(1) or exact(*a, **kw))
    curve, points = P.saturation_curve(df).collect(), P.saturation_points(df).collect()
    assert len(runs) == 1 and len(curve) == 20 and len(points) == 3
    assert sorted(map(str, P.saturation_curve(df.select("*")).collect())) == sorted(map(str, curve))
