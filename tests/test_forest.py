"""Forests grown over blocks of bins: Spark's own tree where nothing is drawn, and shares, settings and SHAP of the whole forest."""
import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from mixcast.operators import boosting, forest
from mixcast.operators import train as TR


def _rows(spark, n=1200):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        a, b, c = float(rng.randrange(20)), float(rng.randrange(12)), float(rng.randrange(2))
        rows.append((i, a, b, c, 3 * a + a * b + 7 * c + rng.gauss(0, 2), float(min(2, int((a + b) // 10))), 1.0 + (i % 3)))
    df = spark.createDataFrame(rows, "campaign_id long, a double, b double, c double, Sales double, label double, weight double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def test_a_tree_of_all_rows_is_sparks_tree(spark, monkeypatch):
    data = _rows(spark).persist()
    monkeypatch.setattr(forest, "copies", lambda u, seed, tree: (np.arange(len(u)), np.ones(len(u))))
    blocks, edges = boosting.blocks_of(data.withColumn("fold", F.lit(-1)), "Sales", "fold", "campaign_id", most=2)
    rows = blocks.map(forest._arrays).collect()
    starts = np.concatenate([[0], np.cumsum([len(e) + 1 for e in edges])])
    got = _grown_here(rows, edges, starts, 4)
    est = DecisionTreeRegressor(featuresCol="features", labelCol="Sales", maxDepth=4, minInstancesPerNode=2)
    tree = est.fit(data)
    assert len(got) == tree.numNodes
    want = sorted({round(r["prediction"], 9) for r in tree.transform(data).select("prediction").distinct().collect()})
    assert sorted({round(r[1], 9) for r in got if r[6] < 0}) == pytest.approx(want)
    data.unpersist()


def _grown_here(rows, edges, starts, depth):
    size = (1 << depth + 1) - 1
    feature, cut, gain, totals = (np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros((3, size)))
    for level in range(depth + 1):
        width, base = 1 << level, (1 << level) - 1
        v = forest._add(rows, 0, feature, cut, level, starts, 0, 1, level < depth)
        totals[:, base:base + width] = v[:3 * width].reshape(3, width)
        if level < depth:
            best = forest.best_splits(v[3 * width:].reshape(2, width, -1), starts, 2, np.ones((width, len(edges)), bool), 0)
            feature[base:base + width], cut[base:base + width], gain[base:base + width] = best
    return forest.tree_rows(feature, cut, gain, totals, edges, 0)


def test_forest_scores_like_sparks_and_does_not_depend_on_partitions(spark):
    data = _rows(spark).persist()
    est = RandomForestRegressor(featuresCol="features", labelCol="Sales", numTrees=12, maxDepth=6, minInstancesPerNode=2,
                                featureSubsetStrategy="all", seed=3)
    own, again, usual = forest.fit_forest(data, est), forest.fit_forest(data.repartition(5), est), est.fit(data)
    assert type(own) is type(usual) and own.getNumTrees == 12 and own.getMaxDepth() == 6 and own.numFeatures == 3

    def error(m):
        return m.transform(data).agg(F.avg((F.col("prediction") - F.col("Sales")) ** 2)).first()[0]
    assert error(own) == pytest.approx(error(usual), rel=0.25)
    assert error(again) == pytest.approx(error(own), rel=1e-9)
    assert own.featureImportances.toArray() == pytest.approx(usual.featureImportances.toArray(), abs=0.05)
    data.unpersist()


def test_classes_with_weights(spark):
    data = _rows(spark).persist()
    est = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight", numTrees=10, maxDepth=6,
                                 minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=3)
    own, usual = forest.fit_forest(data, est), est.fit(data)
    right = lambda m: m.transform(data).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert own.numClasses == 3 and right(own) == pytest.approx(right(usual), abs=0.05)
    shares = own.transform(data).select("probability").first()[0].toArray()
    assert shares.sum() == pytest.approx(1.0)
    data.unpersist()


def test_copies_are_poisson():
    u = np.random.default_rng(1).integers(0, 1 << 63, 200_000).astype(np.uint64)
    rows, n = forest.copies(u, 42, 7)
    assert n.sum() / len(u) == pytest.approx(1.0, abs=0.01) and len(rows) / len(u) == pytest.approx(1 - np.exp(-1), abs=0.01)
    assert (n ** 2).sum() / len(u) == pytest.approx(2.0, abs=0.05) and n.min() == 1


def test_fits_grow_forests_over_blocks(spark, monkeypatch):
    """The pipeline's forest is grown here: Spark's own estimator is not fitted."""
    data = _rows(spark, 200).select("campaign_id", F.col("a").alias("TV"), F.col("b").alias("Radio"), F.col("c").alias("Social_Media"),
                                    F.lit("Nano").alias("Influencer"), "Sales")
    est = RandomForestRegressor(featuresCol="features", labelCol="Sales", numTrees=3, maxDepth=3, featureSubsetStrategy="all", seed=1)
    monkeypatch.setattr(RandomForestRegressor, "_fit", lambda *a: pytest.fail("fitted by rows"))
    model, _ = TR.fit_model(data, est, "regression")
    assert model.predict(data).where("prediction is not null").count() == 200


def test_trees_over_few_cells_read_the_rows_once(spark, monkeypatch):
    """Trees grown whole over sums by cell are those grown level by level over rows, in a few jobs whatever the depth."""
    data = _rows(spark, 3000).withColumn("fold", F.lit(-1)).persist()
    sc = spark.sparkContext
    for classes, label, features in ((0, "Sales", 3), (3, "label", 2)):
        blocks, edges = boosting.blocks_of(data, label, "fold", "campaign_id", weight="weight", most=3)
        settings = (edges, 7, 5, 2, features, classes, 42)
        levels = forest.grow(blocks.map(forest._arrays), *settings)
        cells = boosting._cells(blocks, forest._Kinds(classes)).persist()
        sc.setJobGroup(f"trees{classes}", "")
        trees = forest.grow_by_tree(cells, *settings)
        assert len(sc.statusTracker().getJobIdsForGroup(f"trees{classes}")) <= 2
        sc.setLocalProperty("spark.jobGroup.id", None)
        assert (trees[0] == levels[0]).all() and (trees[1] == levels[1]).all()
        inner = levels[0] >= 0
        assert trees[2][inner] == pytest.approx(levels[2][inner], rel=1e-6) and trees[3] == pytest.approx(levels[3], rel=1e-9, abs=1e-9)
        for whole, other in ((0, "grow"), (1 << 18, "grow_by_tree")):  # which way a fit goes
            monkeypatch.setattr(boosting, "WHOLE", whole)
            est = (RandomForestClassifier if classes else RandomForestRegressor)(
                featuresCol="features", labelCol=label, numTrees=2, maxDepth=2, seed=1, featureSubsetStrategy="all")
            ran, own = [], getattr(forest, other)
            monkeypatch.setattr(forest, other, lambda *a, own=own, ran=ran: ran.append(1) or own(*a))
            assert forest.fit_forest(data, est).getNumTrees == 2 and ran == [1]
        blocks.unpersist()
        cells.unpersist()
    data.unpersist()
