import math

import pytest
from pyspark.sql import functions as F

from mixcast.operators import prepare as PR
from mixcast.sources.campaigns import read_campaigns

RAW = "campaign_id long, TV double, Radio double, Social_Media double, Influencer string, Sales double"


def test_csv_header_rename_and_nan(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("TV,Radio,Social Media,Influencer,Sales\n10,1.5,NaN,Mega,20\n,2,3,,\n5,0,0,Nano,7\n")
    df = read_campaigns(spark, str(p))
    assert df.columns == ["campaign_id", "TV", "Radio", "Social_Media", "Influencer", "Sales"]
    rows = df.orderBy("TV").collect()
    assert rows[0]["TV"] is None and rows[0]["Influencer"] is None and rows[0]["Sales"] is None
    assert [r for r in rows if r["TV"] == 10.0][0]["Social_Media"] is None  # NaN -> null


def test_zero_budget_gives_missing_roi(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 0.0, "Mega", 5.0), (2, 0.0, 2.0, 2.0, "Nano", 8.0)], RAW)
    out = {r["campaign_id"]: r for r in PR.with_roi_shares(PR.with_total_budget(df)).collect()}
    assert out[1]["ROI"] is None and out[1]["TV_Share"] is None
    assert out[2]["ROI"] == 2.0 and out[2]["TV_Share"] == 0.0 and out[2]["Radio_Share"] == 0.5


def test_mode_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([(i, 1.0, 1.0, 1.0, v, 1.0) for i, v in enumerate(["b", "a", "b", "a", "c"])], RAW)
    assert PR.fit_mode(df) == "a"


def test_median_imputation_after_dropping_unlabelled(spark):
    rows = [(1, 1.0, None, 1.0, "Mega", 1.0), (2, 3.0, 4.0, 1.0, None, 2.0), (3, 100.0, 6.0, 1.0, "Mega", None),
            (4, None, 8.0, 1.0, "Nano", 3.0)]
    clean, st = PR.clean_campaigns(spark.createDataFrame(rows, RAW))
    assert st.medians["TV"] == 2.0  # row 3 dropped before the median
    assert st.medians["Radio"] == 6.0 and st.mode == "Mega"
    got = {r["campaign_id"]: r for r in clean.collect()}
    assert 3 not in got and got[4]["TV"] == 2.0 and got[1]["Radio"] == 6.0 and got[2]["Influencer"] == "Mega"


def test_all_null_channel_stays_null(spark):
    rows = [(1, None, 1.0, 1.0, None, 1.0), (2, None, 2.0, 1.0, None, 2.0)]
    clean, st = PR.clean_campaigns(spark.createDataFrame(rows, RAW))
    assert st.medians["TV"] is None and st.mode is None
    assert all(r["TV"] is None for r in clean.collect())


def test_tercile_bins_are_right_closed(spark):
    rows = [(i, 1.0, 1.0, 1.0, "Mega", float(s)) for i, s in enumerate([1, 2, 3, 4, 5, 6, 7])]
    df = spark.createDataFrame(rows, RAW)
    t1, t2 = PR.fit_terciles(df)
    assert t1 == pytest.approx(3.0) and t2 == pytest.approx(5.0)
    out = {r["Sales"]: r["Performance"] for r in PR.with_performance(df, (t1, t2)).collect()}
    assert out[3.0] == "Low" and out[4.0] == "Medium" and out[5.0] == "Medium" and out[6.0] == "High"


def test_shares_sum_to_one(spark):
    rows = [(i, float(i), float(i % 3), 2.5, "Micro", 10.0 + i) for i in range(1, 50)]
    out = PR.with_roi_shares(PR.with_total_budget(spark.createDataFrame(rows, RAW)))
    s = out.select((F.col("TV_Share") + F.col("Radio_Share") + F.col("Social_Share")).alias("s")).collect()
    assert all(math.isclose(r["s"], 1.0, rel_tol=1e-12) for r in s)
