"""P3, P4, P7 and F1 fitted on training rows only: cleaning, enrichment and scaling as one ``pyspark.ml`` stage.

``CampaignPreparer`` is an ``Estimator`` over raw campaigns.  Its ``fit`` finds the channel medians, the most frequent
tier, the terciles of the target and the scaling of the filled channels on the rows it is given; the
``CampaignPreparation`` it returns applies them to any rows as one projection.  Put first in a pipeline, it is refitted
with the pipeline, so that no statistic of held-out rows reaches a model.  Both can be saved and loaded, alone or
inside a pipeline.

Defined results: rows without the target are left out of the fit and kept by the transform; a channel without any value
keeps its nulls; a tier that is missing everywhere stays null; a zero deviation scales by one; without a fitted tercile
the class is null; a class that the rows bring along is kept; without the target only what does not need it is added.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CATEGORIES, CATEGORY, CHANNELS, TARGET_CLF, TARGET_REG
from .features import fit_scaling, onehot_features
from .prepare import (drop_unlabelled, fit_prep_stats, impute, materialize, with_performance, with_roi_shares,
                      with_total_budget)

SCALED = [f"{c}_z" for c in CHANNELS]
ENCODED = [f"{CATEGORY}_{c}" for c in CATEGORIES[1:]]


class CampaignPreparation(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted statistics, applied to rows: filled, enriched, scaled and encoded."""

    fitted = Param(Params._dummy(), "fitted", "statistics of the training rows: medians, mode, terciles, scaling",
                   TypeConverters.identity)

    def __init__(self, fitted: dict | None = None):
        super().__init__()
        if fitted is not None:
            self._set(fitted=fitted)

    @property
    def statistics(self) -> dict:
        return self.getOrDefault(self.fitted)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        known = self.statistics
        brought = TARGET_CLF in dataset.columns
        out = with_total_budget(impute(dataset.drop(*SCALED, *ENCODED), known["medians"], known["mode"]))
        if TARGET_REG in dataset.columns:
            out = with_roi_shares(out)
            if not brought:
                terciles = known["terciles"]
                out = (out.withColumn(TARGET_CLF, F.lit(None).cast("string")) if None in terciles
                       else with_performance(out, terciles))
        scale = known["scaling"]
        z = [((F.col(c) - F.lit(scale[c][0]).cast("double")) / F.lit(scale[c][1] or 1.0)).alias(f"{c}_z") for c in CHANNELS]
        return onehot_features(out.select("*", *z))


class CampaignPreparer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits ``CampaignPreparation`` on the labelled rows of raw campaigns."""

    def _fit(self, dataset: DataFrame) -> CampaignPreparation:
        rows = materialize(drop_unlabelled(dataset).select(*CHANNELS, CATEGORY, TARGET_REG))
        stats = fit_prep_stats(rows)
        scaling = fit_scaling(impute(rows, stats.medians, stats.mode))
        rows.unpersist()
        return CampaignPreparation({"medians": stats.medians, "mode": stats.mode, "terciles": list(stats.terciles),
                                    "scaling": {c: list(v) for c, v in scaling.items()}})


def statistics_table(models: dict[str, CampaignPreparation], spark) -> DataFrame:
    """``(statistic, <name of each model>...)``: the fitted numbers side by side, one row each."""
    def numbers(m: CampaignPreparation) -> dict[str, float | None]:
        s = m.statistics
        out = {f"median_{c}": s["medians"][c] for c in CHANNELS}
        out |= {f"tercile_{i}": t for i, t in enumerate(s["terciles"], 1)}
        return out | {f"{what}_{c}": s["scaling"][c][i] for i, what in enumerate(("mean", "deviation")) for c in CHANNELS}

    columns = {name: numbers(m) for name, m in models.items()}
    rows = [(k, *[None if v[k] is None else float(v[k]) for v in columns.values()]) for k in next(iter(columns.values()))]
    return spark.createDataFrame(rows, "statistic string, " + ", ".join(f"`{n}` double" for n in columns))
