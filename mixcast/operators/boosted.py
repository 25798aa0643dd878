"""K3/K5: the boosting models that are kept, grown over sums by cell (``boosting``) with the rules and settings of
``GBTRegressor`` / ``GBTClassifier``.  Spark's own fit reads every row some ten times a round; here a round reads it once.
One-vs-rest fits of all classes are grown together.  The results are Spark's own model classes."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, OneVsRest, OneVsRestModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import KEY
from .boosting import Fit, blocks_of, boost
from .forest import saved_model, tree_rows


def fit_boosting(data: DataFrame, est):
    """The fitted model of a ``GBTRegressor`` or of a ``OneVsRest`` of ``GBTClassifier`` with the estimator's settings."""
    spark = data.sparkSession
    many = isinstance(est, OneVsRest)
    own = est.getClassifier() if many else est
    blocks, edges = blocks_of(data.withColumn("fold", F.lit(-2)), est.getLabelCol(), "fold", KEY, est.getFeaturesCol())
    kinds = [None]
    if many:
        kinds = list(range(int(blocks.map(_top).fold(-1.0, max)) + 1))
    step = own.getStepSize()
    trees, _, _ = boost(blocks, len(edges), [Fit(-1, step, own.getMaxDepth(), k) for k in kinds], own.getMaxIter(),
                        own.getSubsamplingRate(), own.getMinInstancesPerNode(), own.getSeed(), squares=True)
    blocks.unpersist()
    weights = [step if i else 1.0 for i in range(len(trees))]
    models = []
    for i, kind in enumerate(kinds):
        rows = [(t, node) for t, g in enumerate(trees)
                for node in tree_rows(g.feature[i], g.bin[i], g.gain[i], g.totals[:, i], edges, 0)]
        cls = GBTRegressionModel if kind is None else GBTClassificationModel
        each = own if kind is None else own.copy({own.labelCol: est.getLabelCol(), own.featuresCol: est.getFeaturesCol()})
        models.append(saved_model(spark, each, cls, rows, len(edges), weights, 0 if kind is None else 2, 0))
    if not many:
        return models[0]
    out = OneVsRestModel(models)
    for param in (est.featuresCol, est.labelCol, est.predictionCol, est.rawPredictionCol):
        out._set(**{param.name: est.getOrDefault(param)})
    return out


def _top(row: dict) -> float:
    return float(np.frombuffer(row["y"]).max())
