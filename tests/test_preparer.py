"""Preparation as a pipeline stage: statistics of the training rows only, saved and loaded with the pipeline."""
import statistics

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from mixcast.operators import train as TR
from mixcast.operators.preparer import CampaignPreparation, CampaignPreparer, statistics_table
from mixcast.operators.tuning import cv_raw_trend_scores

RAW = "campaign_id long, TV double, Radio double, Social_Media double, Influencer string, Sales double, fold int"


def _rows(n=240):
    rows = []
    for i in range(n):
        tv = None if i % 11 == 0 else float((i * 13) % 97)
        tier = None if i % 17 == 0 else ["Mega", "Macro", "Micro", "Nano", "Nano"][i % 5]
        sales = None if i % 29 == 0 else 2.0 * (tv or 50.0) + i % 7
        rows.append((i, tv, float(i % 41), float((i * 3) % 13), tier, sales, i % 3))
    return rows


def test_statistics_are_those_of_the_training_rows(spark):
    df = spark.createDataFrame(_rows(), RAW)
    train = df.where("campaign_id < 160")
    got = CampaignPreparer().fit(train).statistics
    rows = [r for r in _rows() if r[0] < 160 and r[5] is not None]
    assert got["medians"]["TV"] == pytest.approx(statistics.median(r[1] for r in rows if r[1] is not None), abs=1e-12)
    assert got["mode"] == "Nano"
    filled = [got["medians"]["TV"] if r[1] is None else r[1] for r in rows]
    assert got["scaling"]["TV"] == pytest.approx([statistics.fmean(filled), statistics.pstdev(filled)], abs=1e-9)
    # what lies outside the training rows changes nothing
    moved = train.union(df.where("campaign_id >= 160").withColumn("TV", F.lit(1e9))).where("campaign_id < 160")
    assert CampaignPreparer().fit(moved).statistics == got


def test_transform_defines_the_odd_cases(spark):
    df = spark.createDataFrame([(1, None, 1.0, 1.0, None, 5.0, 0), (2, None, 3.0, 1.0, None, 7.0, 0),
                                (3, None, 3.0, 1.0, None, None, 0)], RAW)
    model = CampaignPreparer().fit(df)
    out = {r["campaign_id"]: r for r in model.transform(df).collect()}
    assert len(out) == 3 and out[3]["Performance"] is None  # rows without the target stay, without a class
    assert out[1]["TV"] is None and out[1]["TV_z"] is None and out[1]["Influencer"] is None
    assert out[1]["Social_Media_z"] == 0.0 and out[1]["Influencer_Nano"] == 0.0  # zero deviation, no tier
    bare = model.transform(df.drop("Sales", "fold"))
    assert "ROI" not in bare.columns and "Performance" not in bare.columns and bare.count() == 3
    kept = model.transform(df.withColumn("Performance", F.lit("High")).withColumn("TV_z", F.lit(9.0)))
    assert {r["Performance"] for r in kept.collect()} == {"High"} and kept.columns.count("TV_z") == 1
    empty = CampaignPreparer().fit(df.where("false"))
    assert empty.statistics["mode"] is None
    assert [r["Performance"] for r in empty.transform(df).collect()] == [None] * 3


def test_stage_is_saved_and_loaded_alone_and_in_a_pipeline(spark, tmp_path):
    df = spark.createDataFrame(_rows(), RAW)
    est = TR.regression_estimators("quick")["Linear Regression"]
    model, _ = TR.fit_model(df.where("campaign_id < 160 and Sales is not null"), est, "regression", raw=True)
    model.model.write().save(str(tmp_path / "pipeline"))
    back = PipelineModel.load(str(tmp_path / "pipeline"))
    values = lambda m: [(r["campaign_id"], r["prediction"]) for r in m.transform(df).orderBy("campaign_id").collect()]
    assert values(back) == values(model.model) and len(values(back)) == 240
    stage = back.stages[0]
    assert isinstance(stage, CampaignPreparation) and stage.statistics == model.model.stages[0].statistics
    CampaignPreparer().write().save(str(tmp_path / "estimator"))
    again = Pipeline(stages=[CampaignPreparer.load(str(tmp_path / "estimator"))]).fit(df.where("campaign_id < 160"))
    assert again.stages[0].statistics == CampaignPreparer().fit(df.where("campaign_id < 160")).statistics


def test_folds_refit_the_preparation(spark):
    df = spark.createDataFrame(_rows(), RAW).where("Sales is not null")
    scores = {r["fold"]: r["score"] for r in cv_raw_trend_scores(df, "Total_Budget", "Line", k=3).collect()}
    for f in range(3):
        rest, held = [[r for r in _rows() if r[5] is not None and (r[6] == f) is h] for h in (False, True)]
        med = statistics.median(r[1] for r in rest if r[1] is not None)
        xy = lambda rows: [((med if r[1] is None else r[1]) + r[2] + r[3], r[5]) for r in rows]  # noqa: B023, E731
        slope, intercept = statistics.linear_regression(*zip(*xy(rest)))
        sse = sum((y - intercept - slope * x) ** 2 for x, y in xy(held))
        mean = statistics.fmean(y for _, y in xy(held))
        assert scores[f] == pytest.approx(1 - sse / sum((y - mean) ** 2 for _, y in xy(held)), abs=1e-9)
    ml = TR.cross_validate_all(df, "regression", "quick", k=3, only=["Linear Regression"], raw=True)
    assert ml.count() == 3


def test_statistics_side_by_side(spark):
    df = spark.createDataFrame(_rows(), RAW)
    table = statistics_table({"a": CampaignPreparer().fit(df), "b": CampaignPreparer().fit(df.where("fold = 0"))}, spark)
    assert table.columns == ["statistic", "a", "b"] and table.count() == 11
