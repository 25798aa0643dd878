"""Shapley values of tree ensembles from a grid of their predictions are those of scoring every variant."""
import random

import pytest
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

from mixcast.operators import explain as XP
from mixcast.operators import train as TR
from mixcast.operators.predictors import SparkModel


@pytest.mark.parametrize("kind", [RandomForestRegressor, GBTRegressor])
def test_variants_of_trees_are_looked_up(spark, monkeypatch, kind):
    rng, rows = random.Random(4), []
    for i in range(400):
        tv, radio, social, tier = rng.random() * 10, float(rng.randrange(5)), rng.random(), ("Mega", "Macro", "Micro", "Nano", None)[i % 5]
        rows.append((i, tv, radio, social, tier, 3 * tv + radio * tv + 5 * (tier == "Nano") + rng.random()))
    rows += [rows[0], (1, 9.0, 1.0, 0.5, "Nano", 4.0), (None, 2.0, 1.0, 0.1, "Macro", 7.0), (None, 3.0, 1.0, 0.1, None, 7.0)]  # a key twice, no key
    data = spark.createDataFrame(rows, "campaign_id long, TV double, Radio double, Social_Media double, Influencer string, Sales double")
    est = kind(featuresCol="features", labelCol="Sales", maxDepth=4, seed=1, **({"numTrees": 6, "featureSubsetStrategy": "all"} if kind is RandomForestRegressor else {"maxIter": 6}))
    model, _ = TR.fit_model(data, est, "regression")
    background = XP.background_sample(data.where("campaign_id > 5"), 8)
    some = data.where("campaign_id < 25 or campaign_id is null")

    def told():
        return {(r["campaign_id"], r["feature"]): r for r in XP.shap_exact(model, some, background).collect()}
    scored = []
    usual_predict = SparkModel.predict
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", str(kind is GBTRegressor).lower())  # sessions may leave it off
    monkeypatch.setattr(SparkModel, "predict", lambda self, df: scored.append(1) or usual_predict(self, df))
    own = told()
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    assert not scored  # no prediction pass over rows x coalitions x background
    monkeypatch.setattr(XP, "GRID", 0)
    usual = told()
    assert scored and own.keys() == usual.keys() and len(own) == 4 * 26
    for at, r in usual.items():
        assert own[at]["shap_value"] == pytest.approx(r["shap_value"], abs=2e-6) and own[at]["base_value"] == pytest.approx(r["base_value"], abs=2e-6)
        if at[0] not in (0, 1, None):
            assert (own[at]["value"], own[at]["category"]) == (r["value"], r["category"])
