"""The boosting models that are kept: Spark's own trees where nothing is drawn, grown over sums by cell."""
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from mixcast.operators import boosting
from mixcast.operators.boosted import fit_boosting


def _rows(spark, n=1200):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        a, b, c = float(rng.randrange(20)), float(rng.randrange(12)), float(rng.randrange(2))
        sales = 3 * a + a * b + 7 * c + rng.gauss(0, 2)
        rows.append((i, a, b, c, sales, float(min(2, int(sales // 60))), i % 3))
    df = spark.createDataFrame(rows, "campaign_id long, a double, b double, c double, Sales double, label double, fold int")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).persist()


def test_kept_model_is_sparks(spark):
    data = _rows(spark)
    est = GBTRegressor(featuresCol="features", labelCol="Sales", maxIter=8, stepSize=0.2, maxDepth=3, subsamplingRate=1.0,
                       minInstancesPerNode=2, seed=1)
    own, usual = fit_boosting(data, est), est.fit(data)
    assert type(own) is type(usual) and own.treeWeights == usual.treeWeights and own.getMaxDepth() == 3
    told = lambda m: [r[0] for r in m.transform(data).orderBy("campaign_id").select("prediction").collect()]
    assert told(own) == pytest.approx(told(usual), abs=1e-6)
    assert own.featureImportances.toArray() == pytest.approx(usual.featureImportances.toArray(), abs=1e-6)
    data.unpersist()


def test_kept_one_vs_rest_is_sparks(spark):
    data = _rows(spark)
    est = OneVsRest(classifier=GBTClassifier(maxIter=6, stepSize=0.2, maxDepth=3, subsamplingRate=1.0, seed=1),
                    featuresCol="features", labelCol="label")
    own, usual = fit_boosting(data, est), est.fit(data)
    assert type(own) is type(usual) and len(own.models) == 3
    for a, b in zip(own.models, usual.models):
        told = lambda m: np.array([r[0].toArray() for r in m.transform(data).orderBy("campaign_id").select("rawPrediction").collect()])
        assert told(a) == pytest.approx(told(b), abs=1e-6)
    data.unpersist()


def test_partitions_hold_whole_cells_and_levels_read_sums(spark):
    """The levels of a round read an element per partition of cells, not the rows; equal cells meet in one partition."""
    data = _rows(spark, 12_000).repartition(6)
    blocks, edges = boosting.blocks_of(data, "Sales", "fold", "campaign_id")
    groups = boosting._Groups([boosting.Fit(f, 0.1, 2) for f in range(3)])
    cells = boosting._cells(blocks, groups).collect()
    assert 1 < len(cells) <= 4
    every = np.concatenate([c["bins"] for c in cells], axis=1)
    assert every.shape[1] == len(np.unique(every, axis=1).T) == 20 * 12 * 2
    n = sum(groups.sums(c)[0].sum() for c in cells)
    total = sum(groups.sums(c)[1].sum() for c in cells)
    assert n == 12_000 and total == pytest.approx(data.agg(F.sum("Sales")).first()[0])
    seen = sum(groups.seen(groups.sums(c))[0, 1].sum() for c in cells)
    assert seen == data.where("fold != 1").count()


def test_fits_over_partitions_do_not_depend_on_them(spark):
    data = _rows(spark, 12_000)
    est = GBTRegressor(featuresCol="features", labelCol="Sales", maxIter=5, stepSize=0.3, maxDepth=3, subsamplingRate=0.8, seed=1)
    told = lambda m: [r[0] for r in m.transform(data).orderBy("campaign_id").select("prediction").collect()]
    assert told(fit_boosting(data, est)) == pytest.approx(told(fit_boosting(data.repartition(7), est)), abs=1e-8)
    data.unpersist()


def test_fits_over_few_cells_take_two_jobs_a_pack(spark, monkeypatch):
    """Where cells are few a pack of rounds is drawn in one job and grown in another; the trees are those of the levels."""
    data = _rows(spark, 6000)
    blocks, edges = boosting.blocks_of(data, "Sales", "fold", "campaign_id")
    fits = [boosting.Fit(f, step, depth) for f in range(3) for step, depth in ((0.1, 2), (0.3, 3))]
    found = {}
    for name, whole, sent in (("whole", 1 << 18, 1 << 26), ("packs", 1 << 18, 100_000), ("levels", 0, 1)):
        monkeypatch.setattr(boosting, "WHOLE", whole)
        monkeypatch.setattr(boosting, "SENT", sent)
        spark.sparkContext.setJobGroup(name, name)
        found[name] = boosting.boost(blocks, len(edges), fits, 8, squares=True)
        found[name] += (len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)),)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for name in ("packs", "levels"):
        assert found[name][1] == pytest.approx(found["whole"][1], rel=1e-9)
        for a, b in zip(found["whole"][0], found[name][0]):
            assert (a.feature == b.feature).all() and (a.bin == b.bin).all()
            assert a.value == pytest.approx(b.value, abs=1e-9) and a.gain == pytest.approx(b.gain, abs=1e-6)
            assert a.totals == pytest.approx(b.totals, rel=1e-6, abs=1e-6)
    assert found["whole"][3] <= 6 < found["packs"][3] < found["levels"][3]
    assert found["whole"][2].sent.rounds == 8
    blocks.unpersist()
    data.unpersist()


def test_classes_over_few_cells_are_those_of_the_levels(spark, monkeypatch):
    data = _rows(spark, 6000)
    blocks, edges = boosting.blocks_of(data, "label", "fold", "campaign_id")
    fits = [boosting.Fit(f, 0.3, 3, c) for f in range(3) for c in range(3)]
    counts = []
    for whole in (1 << 18, 0):
        monkeypatch.setattr(boosting, "WHOLE", whole)
        trees, sse, outputs = boosting.boost(blocks, len(edges), fits, 5)
        counts.append((trees[-1].value, sse, boosting.class_counts(blocks, fits, outputs, 3)))
    assert counts[0][0] == pytest.approx(counts[1][0], abs=1e-9) and counts[0][1] == pytest.approx(counts[1][1], rel=1e-9)
    assert all((counts[0][2][f] == counts[1][2][f]).all() for f in range(3))
    blocks.unpersist()
    data.unpersist()
