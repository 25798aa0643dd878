"""K1-K8: distributed model fits with ``pyspark.ml``.

Every model is a ``Pipeline`` of the frozen feature stages (fitted on the rows it is
trained on, as a scikit-learn pipeline refits its scaler per CV fold), a fixed label
index for classification, and one estimator.  Cross-validation runs one fit per fold
on ``fold != f`` and scores ``fold == f`` through the same metric aggregates used for
the test split, so every model of every fold is evaluated in one aggregation.
"""

from __future__ import annotations

import functools
import itertools
import time
from concurrent.futures import ThreadPoolExecutor
from statistics import mean, pstdev

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CLASSES, KEY, SEED, TARGET_CLF, TARGET_REG
from .boosted import fit_boosting
from .boosting import BINS, Fit, blocks_of, boost, class_counts, weighted_f1
from .evaluate import classification_metrics, regression_metrics
from .features import feature_names, feature_stages
from .forest import fit_forest
from .mlp import fit_mlp_classifier
from .predictors import SparkModel, predictions
from .splits import with_class_weights

# Model settings of the reference ("reference"); "quick" has the same structure with fewer trees and
# rounds, for unit tests only.
PROFILES = {
    "reference": {"trees": 200, "rounds": 200, "mlp_iter": 2000, "lr_iter": 1000},
    "quick": {"trees": 20, "rounds": 20, "mlp_iter": 100, "lr_iter": 100},
}
# The reference's neural classifier stops after ten epochs that each lower the loss by less than 1e-4 (its library's default);
# Spark compares the loss with its mean over the last 20 iterations, relative to the first loss (ln 3): 1e-3 is the same.
MLP_TOL = 1e-3
ROWS = 50_000  # training rows of a partition, about
# The boosting grid of the reference.
GRID = {"maxIter": [100, 200, 300], "stepSize": [0.05, 0.1, 0.2], "maxDepth": [3, 4, 5]}

LABEL_SQL = ("SELECT *, CAST(CASE Performance WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 END AS DOUBLE)"
             " AS label FROM __THIS__")


def regression_estimators(profile: str = "reference", seed: int = SEED) -> dict:
    """K1-K3: OLS, random forest, gradient boosting (K4, the neural regressor, is in ``mlp``)."""
    p = PROFILES[profile]
    common = {"featuresCol": "features", "labelCol": TARGET_REG}
    return {
        "Linear Regression": LinearRegression(regParam=0.0, solver="normal", **common),
        "Random Forest": RandomForestRegressor(numTrees=p["trees"], maxDepth=10, minInstancesPerNode=2,
                                               featureSubsetStrategy="all", seed=seed, **common),
        "Gradient Boosting": GBTRegressor(maxIter=p["rounds"], stepSize=0.05, maxDepth=4, subsamplingRate=0.8,
                                          minInstancesPerNode=2, seed=seed, **common),
    }


def classification_estimators(profile: str = "reference", seed: int = SEED, n_weight: float | None = None) -> dict:
    """K5: balanced logistic, balanced forest, one-vs-rest boosting, MLP classifier."""
    p = PROFILES[profile]
    common = {"featuresCol": "features", "labelCol": "label"}
    # L2 with C = 1 on a weighted sum of losses equals regParam = 1 / sum(weights) on Spark's mean loss.
    reg = 1.0 / n_weight if n_weight else 0.0
    return {
        "Logistic Regression": LogisticRegression(family="multinomial", regParam=reg, elasticNetParam=0.0,
                                                  standardization=False, maxIter=p["lr_iter"], weightCol="weight",
                                                  **common),
        "Random Forest": RandomForestClassifier(numTrees=p["trees"], maxDepth=10, minInstancesPerNode=2,
                                                featureSubsetStrategy="sqrt", weightCol="weight", seed=seed, **common),
        "Gradient Boosting": OneVsRest(classifier=GBTClassifier(maxIter=p["rounds"], stepSize=0.05, maxDepth=4,
                                                                subsamplingRate=0.8, seed=seed),
                                       parallelism=len(CLASSES), **common),
        "MLP (Deep Learning)": MultilayerPerceptronClassifier(layers=[len(feature_names()), 128, 64, 32, len(CLASSES)],
                                                              maxIter=p["mlp_iter"], tol=MLP_TOL, seed=seed, **common),
    }


def pipeline_for(train: DataFrame, estimator, task: str, raw: bool = False) -> Pipeline:
    stages = feature_stages(train, raw=raw)
    if task == "classification":
        stages.append(SQLTransformer(statement=LABEL_SQL))
    return Pipeline(stages=[*stages, estimator])


def fit_model(train: DataFrame, estimator, task: str, raw: bool = False) -> tuple[SparkModel, float]:
    """The fitted pipeline and its seconds; with ``raw`` the pipeline cleans and enriches the campaigns by itself."""
    t0 = time.time()
    pipeline = pipeline_for(train, estimator, task, raw)
    if isinstance(estimator, (RandomForestRegressor, RandomForestClassifier)):
        prep = Pipeline(stages=pipeline.getStages()[:-1]).fit(train)
        model = PipelineModel(stages=[*prep.stages, fit_forest(prep.transform(train), estimator)])
    elif isinstance(estimator, MultilayerPerceptronClassifier) and estimator.getSolver() == "l-bfgs":
        prep = Pipeline(stages=pipeline.getStages()[:-1]).fit(train)
        model = PipelineModel(stages=[*prep.stages, fit_mlp_classifier(prep.transform(train), estimator)])
    elif _by_cells(estimator):
        prep = Pipeline(stages=pipeline.getStages()[:-1]).fit(train)
        model = PipelineModel(stages=[*prep.stages, fit_boosting(prep.transform(train), estimator)])
    else:
        model = pipeline.fit(train)
    return SparkModel(model, task, CLASSES if task == "classification" else None), round(time.time() - t0, 3)


def _prep(train: DataFrame, task: str) -> DataFrame:
    if task == "classification" and "weight" not in train.columns:
        return with_class_weights(train)
    return train


def compact(df: DataFrame) -> DataFrame:
    """``df`` persisted in partitions that suit its size: a fit runs thousands of short jobs over it, and each costs
    a task per partition, however few rows that holds."""
    n = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(4, cores), -(-n // ROWS))).persist()


def in_pool(tasks: list, parallelism: int = 8) -> list:
    """Results of ``tasks`` (functions of nothing, costliest first) in their order; at most ``parallelism`` run at once,
    each in a scheduler pool of its own, so that under fair scheduling short fits are not held up by long ones."""
    spark = SparkSession.getActiveSession()
    sc = spark.sparkContext

    def run(numbered):
        i, task = numbered
        sc.setLocalProperty("spark.scheduler.pool", f"fit-{i % max(1, parallelism)}")
        try:
            return task()
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(run, enumerate(tasks)))


def cross_validate(train: DataFrame, estimator, name: str, task: str, k: int = 5, parallelism: int = 4) -> DataFrame:
    """K6: per-fold scores (R² or weighted F1) of one estimator: (model, fold, score)."""
    return _fold_scores(train, {name: estimator}, task, k, parallelism)


# costliest first, so that the last fits to run are short ones
_COST = {MultilayerPerceptronClassifier: 0, OneVsRest: 1, GBTRegressor: 1, RandomForestClassifier: 2, RandomForestRegressor: 2}


def _fold_scores(train: DataFrame, ests: dict, task: str, k: int, parallelism: int, raw: bool = False) -> DataFrame:
    """The fits of all estimators on all folds share one compact table and one pool; all are scored in one aggregation.

    With ``raw`` every fit cleans by the statistics of its own folds, so boosting is fitted like the others."""
    data = compact(train)

    def one(name, est, f):
        model, _ = fit_model(data.where(F.col("fold") != f), est.copy(), task, raw)
        held = data.where(F.col("fold") == f).withColumn("split", F.lit(str(f)))
        return predictions(held, {name: model}, task)

    boosted = [n for n in ests if _boosting(ests[n]) is not None and not raw]
    names = sorted((n for n in ests if n not in boosted), key=lambda n: _COST.get(type(ests[n]), 9))
    tasks = [functools.partial(boosted_scores, data, ests[n], task, k) for n in boosted]
    tasks += [functools.partial(one, n, ests[n], f) for n in names for f in range(k)]
    parts = in_pool(tasks, parallelism)
    found = [(n, f, s) for n, scores in zip(boosted, parts) for f, s in enumerate(scores)]
    if names:
        preds = functools.reduce(DataFrame.unionByName, parts[len(boosted):])
        metrics, score = (regression_metrics, "r2") if task == "regression" else (classification_metrics, "f1")
        found += [tuple(r) for r in metrics(preds, ("model", "split"), digits=12).select(
            "model", F.col("split").cast("int"), score).collect()]  # models x folds rows
    data.unpersist()
    return train.sparkSession.createDataFrame(found, "model string, fold int, score double")


def _boosting(est):
    """The boosting estimator of a fit, if it is one."""
    own = est.getClassifier() if isinstance(est, OneVsRest) else est
    return own if isinstance(own, (GBTRegressor, GBTClassifier)) else None


def _by_cells(est) -> bool:
    """Whether ``fit_boosting`` knows all settings of a fit: unweighted rows, no validation rows, the usual bins and losses."""
    own = _boosting(est)
    if own is None or isinstance(own, GBTRegressor) and own.getLossType() != "squared":
        return False
    return (not own.isDefined(own.weightCol) and not own.isDefined(own.validationIndicatorCol) and own.getMaxBins() == BINS
            and own.getFeatureSubsetStrategy() == "all" and own.getMinInfoGain() == 0.0 and own.getMinWeightFractionPerNode() == 0.0
            and not (isinstance(est, OneVsRest) and est.isDefined(est.weightCol)))


def boosted_scores(data: DataFrame, est, task: str, k: int) -> list[float]:
    """R² or weighted F1 of boosting on every fold, all folds (and classes) grown together."""
    own = _boosting(est)
    label = TARGET_REG if task == "regression" else "label"
    stages = feature_stages(data) + ([SQLTransformer(statement=LABEL_SQL)] if task == "classification" else [])
    flat = Pipeline(stages=stages).fit(data).transform(data)
    blocks, edges = blocks_of(flat, label, "fold", KEY)
    kinds = [None] if task == "regression" else list(range(len(CLASSES)))
    fits = [Fit(f, own.getStepSize(), own.getMaxDepth(), c) for f in range(k) for c in kinds]
    _, sse, outputs = boost(blocks, len(edges), fits, own.getMaxIter(), own.getSubsamplingRate(), own.getMinInstancesPerNode(), SEED)
    if task == "regression":
        spread = _spread(flat)
        scores = [1.0 - float(sse[-1, f]) / spread[f] for f in range(k)]
    else:
        counts = class_counts(blocks, fits, outputs, len(CLASSES))
        scores = [weighted_f1(counts[f]) for f in range(k)]
    blocks.unpersist()
    return scores


def _spread(data: DataFrame) -> dict[int, float]:
    """Squared distance of the target from its mean, by fold."""
    return {r["fold"]: r["v"] for r in data.groupBy("fold").agg((F.var_pop(TARGET_REG) * F.count(TARGET_REG)).alias("v")).collect()}


def estimators_for(train: DataFrame, task: str, profile: str, only: list[str] | None = None) -> dict:
    """The task's estimators by name; ``train`` holds the class weights for classification."""
    if task == "regression":
        ests = regression_estimators(profile)
    else:
        ests = classification_estimators(profile, n_weight=train.agg(F.sum("weight")).first()[0])
    return {n: e for n, e in ests.items() if not only or n in only}


def cross_validate_all(train: DataFrame, task: str, profile: str = "reference", k: int = 5,
                       only: list[str] | None = None, parallelism: int = 8, raw: bool = False) -> DataFrame:
    """K6: fold scores of every estimator of the task: (model, fold, score)."""
    train = _prep(train, task)
    return _fold_scores(train, estimators_for(train, task, profile, only), task, k, parallelism, raw)


def train_all(train: DataFrame, task: str = "regression", profile: str = "reference", k: int = 5,
              cv: bool = True, only: list[str] | None = None, parallelism: int = 4, raw: bool = False
              ) -> tuple[dict, DataFrame, DataFrame | None]:
    """K6: fit every model on the training rows, time each fit, cross-validate; ``raw`` as in ``fit_model``.

    Returns (models by name, run table, CV score table or None)."""
    train = _prep(train, task)
    ests = estimators_for(train, task, profile, only)
    data = compact(train)
    models, runs = {}, []
    for name, est in ests.items():  # one after another: each fit is timed
        models[name], secs = fit_model(data, est, task, raw)
        runs.append((task, name, False, secs, *_size(name, est)))
    data.unpersist()
    run_df = train.sparkSession.createDataFrame(runs, "task string, model string, tuned boolean, train_time_s double, "
                                                      "n_params long, complexity string")
    return models, run_df, _fold_scores(train, ests, task, k, parallelism, raw) if cv else None


def _size(name: str, est) -> tuple[int, str]:
    """Parameter estimate and complexity class, by the reference's rules."""
    if isinstance(est, MultilayerPerceptronClassifier):
        layers = est.getLayers()
        return sum(a * b for a, b in zip(layers[:-1], layers[1:])), "very high"
    n = None
    for attr in ("getNumTrees", "getMaxIter"):
        if hasattr(est, attr) and not isinstance(est, (LinearRegression, LogisticRegression)):
            n = getattr(est, attr)()
            break
    if isinstance(est, OneVsRest):
        n = est.getClassifier().getMaxIter()
    if n is not None:
        return n * 50, "high" if n > 150 else "moderate"
    return 10, "low"


def boosting_prefix_scores(data: DataFrame, rounds: list[int], settings: list[tuple[float, int]], k: int = 5,
                           seed: int = SEED, share: float = 0.8) -> dict[tuple[float, int, int], list[float]]:
    """R² on each fold of each (step, depth) after each number of ``rounds``: all settings and folds grown together.

    Round m of boosting depends on the rounds before it only, so the first r trees of a longer fit are the fit of r
    rounds, and one run of the most rounds scores every number of rounds.
    """
    spread = _spread(data)
    blocks, edges = blocks_of(data, TARGET_REG, "fold", KEY)
    fits = [Fit(f, *s) for s in settings for f in range(k)]
    _, sse, _ = boost(blocks, len(edges), fits, max(rounds), share, 2, seed)
    blocks.unpersist()
    return {(*s, r): [1.0 - float(sse[r - 1, i * k + f]) / spread[f] for f in range(k)]
            for i, s in enumerate(settings) for r in rounds}


def grid_search(train: DataFrame, task: str = "regression", k: int = 5, grid: dict | None = None,
                parallelism: int = 4):
    """K7: grid over boosting rounds, step size and depth; CV on the fold column; refit on all training rows.

    Regression settings that differ in rounds only share their fits, and the fits of all settings and folds are grown
    together (``boosting``).  The scaler is fitted on all training rows: trees do not depend on a feature's scale.
    Returns (best model as ``SparkModel``, table of settings, cv_mean, cv_std)."""
    grid = grid or GRID
    if task == "classification":
        return _grid_search_classes(_prep(train, task), k, grid, parallelism)
    prep = Pipeline(stages=feature_stages(train)).fit(train)
    data = compact(prep.transform(train).select(KEY, "features", TARGET_REG, "fold"))
    scores = boosting_prefix_scores(data, grid["maxIter"], list(itertools.product(grid["stepSize"], grid["maxDepth"])), k)
    rows = [({"maxIter": r, "stepSize": step, "maxDepth": depth}, mean(s), pstdev(s)) for (step, depth, r), s in scores.items()]
    best = max(rows, key=lambda row: row[1])[0]
    model = fit_boosting(data, GBTRegressor(featuresCol="features", labelCol=TARGET_REG, subsamplingRate=0.8,
                                            minInstancesPerNode=2, seed=SEED, **best))
    data.unpersist()
    table = train.sparkSession.createDataFrame([(str(dict(sorted(s.items()))), m, d) for s, m, d in rows],
                                               "settings string, cv_mean double, cv_std double")
    return SparkModel(PipelineModel(stages=[*prep.stages, model]), "regression"), table


def _grid_search_classes(train: DataFrame, k: int, grid: dict, parallelism: int):
    """The grid for one-vs-rest boosting, scored by weighted F1."""
    settings = [dict(zip(grid, c)) for c in itertools.product(*grid.values())]
    est = OneVsRest(classifier=GBTClassifier(), featuresCol="features", labelCol="label")
    maps = ParamGridBuilder().addGrid(est.classifier, [GBTClassifier(subsamplingRate=0.8, seed=SEED, **c)
                                                       for c in settings]).build()
    prep = Pipeline(stages=[*feature_stages(train), SQLTransformer(statement=LABEL_SQL)]).fit(train)
    judge = MulticlassClassificationEvaluator(labelCol="label", metricName="weightedFMeasure")
    found = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=judge, foldCol="fold", numFolds=k,
                           parallelism=parallelism, seed=SEED).fit(prep.transform(train))
    rows = [(str(dict(sorted(s.items()))), float(m), float(d))
            for s, m, d in zip(settings, found.avgMetrics, found.stdMetrics)]
    table = train.sparkSession.createDataFrame(rows, "settings string, cv_mean double, cv_std double")
    return SparkModel(PipelineModel(stages=[*prep.stages, found.bestModel]), "classification", CLASSES), table
