"""The feature pipeline (scaled channels, one-hot tier, assembled vector).

Scaling is fitted on the training rows only (two aggregates: mean and population std)
and frozen into a ``SQLTransformer``; the one-hot encoding over the fixed category list
needs no fit.  Both stay Catalyst expressions inside the ML ``Pipeline``.
"""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CATEGORIES, CATEGORY, CHANNELS


def feature_names() -> list[str]:
    """names after encoding: the channels, then one column per non-base tier."""
    return [*CHANNELS, *[f"{CATEGORY}_{c}" for c in CATEGORIES[1:]]]


def fit_scaling(train: DataFrame, cols=tuple(CHANNELS)) -> dict:
    """Mean and population std of each column over the training rows (one aggregation)."""
    row = train.agg(*[e for c in cols for e in (F.avg(c).alias(f"{c}_m"), F.stddev_pop(c).alias(f"{c}_s"))]).first()
    return {c: (row[f"{c}_m"], row[f"{c}_s"]) for c in cols}


def _lit(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def scale_sql(stats: dict) -> str:
    """standardised channels; a zero std leaves the centred value (sklearn divides by 1)."""
    parts = []
    for c, (m, s) in stats.items():
        s = s if s else 1.0
        parts.append(f"({c} - {_lit(m)}) / {_lit(s)} AS {c}_z")
    return ", ".join(parts)


def onehot_sql(col: str = CATEGORY, categories=tuple(CATEGORIES)) -> str:
    """one 0/1 column per category after the first; unknown or null -> all zero."""
    return ", ".join(f"CAST(coalesce({col} = '{c}', false) AS DOUBLE) AS {col}_{c}" for c in categories[1:])


def feature_stages(train: DataFrame, output: str = "features", raw: bool = False) -> list:
    """F1-F3 as pipeline stages fitted on ``train``: SQLTransformer + VectorAssembler.

    With ``raw``, ``train`` holds uncleaned campaigns and the first stage cleans and enriches too (``preparer``)."""
    cols = [f"{c}_z" for c in CHANNELS] + [f"{CATEGORY}_{c}" for c in CATEGORIES[1:]]
    assembled = VectorAssembler(inputCols=cols, outputCol=output, handleInvalid="keep")
    if raw:
        from .preparer import CampaignPreparer

        return [CampaignPreparer().fit(train), assembled]
    stats = fit_scaling(train)
    stmt = f"SELECT *, {scale_sql(stats)}, {onehot_sql()} FROM __THIS__"
    return [SQLTransformer(statement=stmt), assembled]


def scaled_features(df: DataFrame, train: DataFrame) -> DataFrame:
    """F1 as a table: key and standardised channels (train-fitted)."""
    stats = fit_scaling(train)
    return df.select("*", *[((F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)).alias(f"{c}_z")
                            for c, (m, s) in stats.items()])


def onehot_features(df: DataFrame, col: str = CATEGORY, categories=tuple(CATEGORIES)) -> DataFrame:
    """F2 as a table."""
    return df.select("*", *[F.coalesce(F.col(col) == F.lit(c), F.lit(False)).cast("double").alias(f"{col}_{c}")
                            for c in categories[1:]])
