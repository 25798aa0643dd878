from pyspark.sql import functions as F

from mixcast.operators import score as SC
from mixcast.operators.predictors import TrendModel


def test_scenario_validation_reasons(spark):
    bodies = [
        (1, '{"TV": 10, "Radio": 1, "Social_Media": 1, "Influencer": "Mega", "model": "A"}'),
        (2, '{"TV": -1, "Radio": 1, "Social_Media": 1, "Influencer": "Mega"}'),
        (3, '{"TV": 1, "Radio": 1, "Social_Media": 1, "Influencer": "Giga"}'),
        (4, '{"TV": 1, "Radio": 1, "Social_Media": 1, "Influencer": "Nano", "model": "Nope"}'),
        (5, '{"TV": 1, "Radio": 1, "Social_Media": 1, "Influencer": "Nano"}'),
        (6, '{"TV": 1, "Radio": 1, "Influencer"'),
        (7, '{"TV": 1, "Radio": 1, "Influencer": "Nano"}'),
    ]
    req = spark.createDataFrame(bodies, "request_id long, body string")
    v = SC.validate_scenarios(SC.parse_scenarios(req), ["A", "B"], "B")
    got = {r["request_id"]: (r["reason"], r["model"]) for r in v.collect()}
    assert got[1] == (None, "A")
    assert got[2][0] == "negative_budget"
    assert got[3][0] == "unknown_influencer"
    assert got[4][0] == "model_not_found"
    assert got[5] == (None, "B")  # missing model -> default
    assert got[6][0] == "invalid_json"
    assert got[7][0] == "missing_field"


def test_scoring_zero_budget_roi_is_zero(spark):
    acc = spark.createDataFrame([(1, 0.0, 0.0, 0.0, "Mega", "A"), (2, 10.0, 5.0, 5.0, "Nano", "A")],
                                "request_id long, TV double, Radio double, Social_Media double, Influencer string, "
                                "model string")
    m = TrendModel("Total_Budget", 2.0, 3.0)
    out = {r["request_id"]: r for r in SC.score_scenarios(acc, {"A": m}, with_timestamp=False).collect()}
    assert out[1]["roi_estimate"] == 0.0 and out[1]["predicted_sales_M"] == 2.0
    assert out[2]["predicted_sales_M"] == 62.0 and out[2]["roi_estimate"] == 3.1 and out[2]["profit_estimate_M"] == 42.0


def test_resolver_prefers_tuned(spark):
    reg = spark.createDataFrame([("regression", "GB", False, 0.8), ("regression", "GB", True, 0.9),
                                 ("regression", "LR", False, 0.5)], "task string, model string, tuned boolean, score double")
    out = {(r["model"], r["tuned"]) for r in SC.resolve_models(SC.model_registry(reg)).collect()}
    assert out == {("GB", True), ("LR", False)}


def test_merge_metadata_right_wins(spark):
    left = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string")
    right = spark.createDataFrame([("b", "3"), ("c", "4")], "key string, value string")
    assert {r["key"]: r["value"] for r in SC.merge_metadata(left, right).collect()} == {"a": "1", "b": "3", "c": "4"}


def test_feature_labels_and_model_info(spark):
    df = spark.createDataFrame([("TV",), ("Influencer_Macro",), ("Other",)], "feature string")
    got = {r["feature"]: r["label"] for r in SC.label_features(df).collect()}
    assert got == {"TV": "TV budget", "Influencer_Macro": "Influencer Macro", "Other": "Other"}
    reg = spark.createDataFrame([("regression", "B", False, 0.5), ("regression", "A", False, 0.9),
                                 ("classification", "C", False, 0.7)], "task string, model string, tuned boolean, score double")
    info = {r["task"]: r for r in SC.model_info(SC.model_registry(reg)).collect()}
    assert info["regression"]["available_models"] == "A, B" and info["regression"]["best_model"] == "A"
    assert info["classification"]["n_models"] == 1 and info["classification"]["status"] == "healthy"
    assert info["regression"]["target"] == "Sales" and info["regression"]["input_features"] == "TV, Radio, Social_Media, Influencer"
    gone = {r["task"]: r for r in SC.model_info(SC.model_registry(reg.where("task = 'regression'"))).collect()}
    assert gone["classification"]["status"] == "degraded" and gone["classification"]["n_models"] == 0
    assert gone["regression"]["status"] == "healthy"


class _Fails:
    """A model that has no answer for some rows, and one whose plan cannot be built."""

    def __init__(self, whole):
        self.whole = whole

    def predict(self, df):
        if self.whole:
            raise ValueError("no such pipeline")
        tv = F.col("TV")
        return df.withColumn("prediction", F.when(tv == 1, None).when(tv == 2, float("nan")).when(tv == 3, float("inf")).otherwise(tv))


def test_failing_rows_are_set_aside(spark, tmp_path):
    acc = spark.createDataFrame([(i, float(i % 5), 1.0, 1.0, "Mega", "AB"[i % 2] if i < 10 else "C") for i in range(14)],
                                "request_id long, TV double, Radio double, Social_Media double, Influencer string, model string")
    models = {"A": _Fails(False), "B": TrendModel("TV", 0.0, 1.0), "C": _Fails(True)}
    scored, rejected = SC.score_quarantined(acc, models, with_timestamp=False)
    good = {r["request_id"] for r in scored.collect()}
    bad = {r["request_id"]: (r["model"], r["reason"]) for r in rejected.collect()}
    assert good == {0, 1, 3, 4, 5, 7, 9} and set(bad) == set(range(14)) - good
    assert bad[6] == ("A", "prediction_failed") and bad[12] == ("C", "prediction_failed: ValueError")
    # the stream shares the path
    from mixcast.streaming.score_stream import read_rejected, read_scored, stream_score
    src = str(tmp_path / "in")
    acc.select("request_id", F.to_json(F.struct("TV", "Radio", "Social_Media", "Influencer", "model")).alias("body")).write.parquet(src)
    stream_score(spark, src, models, "B", str(tmp_path / "out"), str(tmp_path / "ck"), with_timestamp=False).awaitTermination()
    assert {r["request_id"] for r in read_scored(spark, str(tmp_path / "out")).collect()} == good
    assert {r["request_id"]: (r["model"], r["reason"]) for r in read_rejected(spark, str(tmp_path / "out")).collect()} == bad
