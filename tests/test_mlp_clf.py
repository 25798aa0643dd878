"""The neural classifier: the losses of Spark's fit step by step, its stop, and one job per evaluation."""
import random

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from mixcast.operators import mlp
from mixcast.operators import train as TR
from mixcast.session import ship_package


def _rows(spark, n=1280):
    rng, rows = random.Random(7), []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, a, b, c, 0.0 if a + b * c < -0.5 else 1.0 if a - b < 0.5 else 2.0))
    df = spark.createDataFrame(rows, "campaign_id long, a double, b double, c double, label double").coalesce(1)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).persist()


def _est(**more):
    return MultilayerPerceptronClassifier(layers=[3, 16, 8, 3], seed=42, featuresCol="features", labelCol="label", **more)


def test_losses_are_sparks(spark):
    """1,280 rows of one partition are whole blocks of 128, so Spark's mean of block means is the mean."""
    ship_package(spark)
    data = _rows(spark)
    est = _est(maxIter=40, tol=1e-9)
    own, losses = mlp.mlp_weights(data, est)
    usual = est.fit(data)
    assert losses[:20] == pytest.approx(list(usual.summary().objectiveHistory)[:20], rel=1e-4)
    assert len(losses) == 41 and losses[-1] == pytest.approx(usual.summary().objectiveHistory[-1], rel=0.02)
    model = mlp.fit_mlp_classifier(data, est)
    assert type(model) is type(usual) and model.numFeatures == 3 and list(model.getLayers()) == [3, 16, 8, 3]
    right = lambda m: m.transform(data).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert right(model) == pytest.approx(right(usual), abs=0.02) and right(model) > 0.9
    data.unpersist()


def test_it_leaves_a_flat_loss_and_stops_as_spark_does(spark):
    ship_package(spark)
    data = _rows(spark)
    _, losses = mlp.mlp_weights(data, _est(maxIter=2000, tol=1e-3))
    assert losses[-1] < 0.01 < losses[0]
    steps = _est(maxIter=2000, tol=1e-3).fit(data).summary().totalIterations
    assert len(losses) == pytest.approx(steps, rel=0.1)
    data.unpersist()


def test_gradient_is_that_of_the_loss():
    rng, layers = np.random.default_rng(3), [4, 5, 3]
    vec = rng.normal(size=sum(a * b + b for a, b in zip(layers[:-1], layers[1:])))
    x, y = rng.normal(size=(30, 4)), rng.integers(0, 3, 30)
    _, grads = mlp._cross_entropy(mlp._unflat(vec, layers), x, y)
    for i in range(0, len(vec), 7):
        e = np.zeros(len(vec))
        e[i] = 1e-6
        up, down = (mlp._cross_entropy(mlp._unflat(vec + s * e, layers), x, y)[0] for s in (1, -1))
        assert mlp._flat(grads)[i] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-6)


def test_pipelines_fit_over_packed_rows(spark, monkeypatch):
    data = _rows(spark, 300).select("campaign_id", F.col("a").alias("TV"), F.col("b").alias("Radio"), F.col("c").alias("Social_Media"),
                                    F.lit("Nano").alias("Influencer"),
                                    F.element_at(F.array(F.lit("Low"), F.lit("Medium"), F.lit("High")), F.col("label").cast("int") + 1).alias("Performance"))
    monkeypatch.setattr(MultilayerPerceptronClassifier, "_fit", lambda *a: pytest.fail("fitted by blocks"))
    est = TR.classification_estimators("quick")["MLP (Deep Learning)"]
    est.setMaxIter(3)
    model, _ = TR.fit_model(data, est, "classification")
    assert model.predict(data).where("prediction is not null and score_Low is not null").count() == 300
