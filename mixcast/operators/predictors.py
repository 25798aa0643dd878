"""Predictors behind one interface, and the long prediction table all evaluations read.

A predictor adds ``prediction`` (regression: double; classification: label string plus
one ``score_<class>`` column per class) to a DataFrame.  Two kinds exist:

* ``TrendModel`` / ``TercileClassifier``: closed-form least-squares predictors whose
  coefficients are two aggregates over the training rows; their output is plain SQL,
  so every evaluation can be checked against an independent engine;
* ``SparkModel``: a fitted ``pyspark.ml`` ``PipelineModel`` (see ``operators.train``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CLASSES, KEY, TARGET_CLF, TARGET_REG


@dataclass
class TrendModel:
    """y = intercept + slope * feature, fitted by ``regr_intercept`` / ``regr_slope``."""
    feature: str
    intercept: float
    slope: float
    task: str = "regression"

    @classmethod
    def fit(cls, train: DataFrame, feature: str, target: str = TARGET_REG) -> "TrendModel":
        row = train.agg(F.regr_intercept(target, feature).alias("a"), F.regr_slope(target, feature).alias("b")).first()
        return cls(feature, row["a"], row["b"])

    def expr(self, columns=None):
        x = F.col(self.feature)
        if columns is not None and self.feature == "Total_Budget" and "Total_Budget" not in columns:
            x = F.col("TV") + F.col("Radio") + F.col("Social_Media")
        return F.lit(self.intercept) + F.lit(self.slope) * x

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.expr(df.columns))

    n_params = 2
    complexity = "low"


@dataclass
class TercileClassifier:
    """Class by comparing a trend prediction with the tercile edges of the target.

    Scores: High = prediction, Low = -prediction, Medium = -|prediction - mid| with mid the
    middle of the two edges; rounded to 6 digits before any ranking.
    """
    trend: TrendModel
    t1: float
    t2: float
    task: str = "classification"

    def predict(self, df: DataFrame) -> DataFrame:
        p = self.trend.expr(df.columns)
        mid = (self.t1 + self.t2) / 2
        label = F.when(p <= F.lit(self.t1), CLASSES[0]).when(p <= F.lit(self.t2), CLASSES[1]).otherwise(CLASSES[2])
        from ..functions.exprs import rnd
        return df.select("*", label.alias("prediction"), rnd(-p, 6).alias("score_Low"),
                         rnd(-F.abs(p - F.lit(mid)), 6).alias("score_Medium"), rnd(p, 6).alias("score_High"))

    n_params = 4
    complexity = "low"


class SparkModel:
    """A fitted ML pipeline; classification pipelines carry their label order in ``labels``."""

    def __init__(self, model, task: str, labels: list[str] | None = None, name: str | None = None):
        self.model, self.task, self.labels, self.name = model, task, labels, name

    def predict(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df)
        if self.task == "regression":
            return out
        labels = self.labels or CLASSES
        label = F.element_at(F.array(*[F.lit(c) for c in labels]), F.col("prediction").cast("int") + 1)
        if "probability" in out.columns:
            arr = vector_to_array("probability")
        else:  # one-vs-rest: raw margins per class
            arr = vector_to_array("rawPrediction")
        scored = out.withColumn("__s", arr).withColumn("prediction", label)
        return scored.select(*[c for c in scored.columns if c not in ("__s",)],
                             *[F.col("__s")[i].alias(f"score_{c}") for i, c in enumerate(labels)])


def predictions(df: DataFrame, models: dict, task: str = "regression", keep: list[str] | None = None) -> DataFrame:
    """Long table (key, model, split, actual, predicted[, score_*], keep...) for every model.

    One narrow projection per model, unioned: the input is scanned once per model and
    never shuffled.
    """
    keep = keep or []
    actual = TARGET_REG if task == "regression" else TARGET_CLF
    split = F.col("split") if "split" in df.columns else F.lit("all")
    parts = []
    for name, m in models.items():
        out = m.predict(df)
        cols = [F.col(KEY), F.lit(name).alias("model"), split.alias("split"), F.col(actual).alias("actual"),
                F.col("prediction").cast("double" if task == "regression" else "string").alias("predicted")]
        if task == "classification":
            cols += [F.col(f"score_{c}").cast("double").alias(f"score_{c}") for c in CLASSES]
        parts.append(out.select(*cols, *keep))
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res
