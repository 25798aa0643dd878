"""Boosting of many settings and folds at once equals separate fits, and the best setting wins."""
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from mixcast.operators import boosting
from mixcast.operators import evaluate as EV
from mixcast.operators import train as TR
from mixcast.operators.features import feature_stages
from mixcast.operators.predictors import predictions
from mixcast.plans import catalog as C

SF = "/root/testdata/sf0.001"


def _few_values(spark, n=900):
    """Rows whose features have few values, so that every cut is the same whichever way bins are drawn."""
    rng = random.Random(3)
    rows = []
    for i in range(n):
        tv, radio, sm = float(rng.randrange(20)), float(rng.randrange(12)), float(rng.randrange(6))
        sales = 3 * tv + radio * sm + rng.gauss(0, 4)
        rows.append((i, tv, radio, sm, rng.choice(["Mega", "Macro", "Micro", "Nano"]), sales, i % 3,
                     ["Low", "Medium", "High"][min(2, max(0, int(sales // 30)))]))
    return spark.createDataFrame(rows, "campaign_id long, TV double, Radio double, Social_Media double, Influencer string, "
                                       "Sales double, fold int, Performance string")


def test_lockstep_boosting_equals_separate_fits(spark):
    train = _few_values(spark)
    data = Pipeline(stages=feature_stages(train)).fit(train).transform(train).persist()
    settings = [(0.1, 3), (0.2, 4), (0.05, 1)]
    shared = TR.boosting_prefix_scores(data, [1, 2, 6], settings, k=3, share=1.0)
    for step, depth in settings:
        for fold in range(3):
            est = GBTRegressor(featuresCol="features", labelCol="Sales", subsamplingRate=1.0, minInstancesPerNode=2,
                               maxIter=6, stepSize=step, maxDepth=depth, seed=TR.SEED)
            held = data.where(F.col("fold") == fold)
            errors = est.fit(data.where(F.col("fold") != fold)).evaluateEachIteration(held, "squared")
            spread = held.agg(F.var_pop("Sales")).first()[0]
            for r in (1, 2, 6):
                assert shared[step, depth, r][fold] == pytest.approx(1 - errors[r - 1] / spread, abs=1e-7)
    data.unpersist()


def test_lockstep_classes_equal_one_vs_rest(spark):
    train = _few_values(spark)
    est = OneVsRest(classifier=GBTClassifier(maxIter=5, stepSize=0.1, maxDepth=3, subsamplingRate=1.0, seed=1),
                    featuresCol="features", labelCol="label")
    got = TR.boosted_scores(train, est, "classification", 3)
    for fold in range(3):
        m, _ = TR.fit_model(train.where(F.col("fold") != fold), est, "classification")
        preds = predictions(train.where(F.col("fold") == fold), {"m": m}, "classification")
        assert got[fold] == pytest.approx(EV.classification_metrics(preds, ("model",), digits=12).first()["f1"], abs=0.01)


def test_a_forgotten_block_starts_again(spark, monkeypatch):
    train = _few_values(spark, 300)
    data = Pipeline(stages=feature_stages(train)).fit(train).transform(train).repartition(5).persist()
    whole = TR.boosting_prefix_scores(data, [3, 30], [(0.1, 2)], k=2)
    monkeypatch.setattr(boosting, "PACK", 2)  # many packs, the last one empty or not
    again = TR.boosting_prefix_scores(data, [3, 30], [(0.1, 2)], k=2)
    assert all(again[s] == pytest.approx(whole[s]) for s in whole)
    blocks, edges = boosting.blocks_of(data, "Sales", "fold", "campaign_id")
    fits = [boosting.Fit(0, 0.1, 2)]
    _, sse, outputs = boosting.boost(blocks, len(edges), fits, 4)
    fresh = []
    for row in blocks.collect():  # nothing is held here
        b = outputs(row)
        fresh.append(((b.y - b.out) ** 2 * b.held).sum())
    assert sum(fresh) == pytest.approx(sse[3, 0])
    data.unpersist()


def test_grid_has_every_setting_and_refits_the_best(spark):
    train = C.reg_table(spark, SF).where(F.col("split") == "train")
    model, table = TR.grid_search(train, grid={"maxIter": [1, 3], "stepSize": [0.1], "maxDepth": [2, 3]}, k=2)
    rows = table.collect()
    assert len({r["settings"] for r in rows}) == 4
    best = max(rows, key=lambda r: r["cv_mean"])["settings"]
    gbt = model.model.stages[-1]
    assert best == str({"maxDepth": gbt.getMaxDepth(), "maxIter": gbt.getNumTrees, "stepSize": gbt.getStepSize()})


def test_classification_comparison_has_fold_scores(spark):
    train = C.clf_train(spark, SF)
    names = ["Logistic Regression", "Random Forest"]
    cv = TR.cross_validate_all(train, "classification", "quick", k=2, only=names).persist()
    assert cv.count() == 4 and cv.where("score > 0.4 and score <= 1").count() == 4
    models, _, _ = TR.train_all(train, "classification", "quick", cv=False, only=names)
    rows = EV.model_comparison(predictions(C.test_only(C.clf_table(spark, SF)), models, "classification"), cv,
                               "classification").collect()
    assert len(rows) == 2 and all(r["cv_mean"] is not None and r["cv_std"] is not None for r in rows)
