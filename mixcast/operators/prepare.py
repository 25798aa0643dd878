"""Cleaning (target filter, median / mode imputation) and enrichment.

Statistics (medians, mode, tercile edges) are computed once by distributed jobs and
enter the row-wise plan as literals, so the plan stays one projection that Catalyst
can fold and push down.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import safe_div
from ..functions.quantiles import exact_quantiles, quantiles
from ..schema import CATEGORY, CHANNELS, CLASSES, KEY, TARGET_REG


@dataclass
class PrepStats:
    medians: dict
    mode: str | None
    terciles: tuple


def materialize(df: DataFrame, how: str = "persist") -> DataFrame:
    """Reuse an intermediate: ``persist`` (recomputed from lineage if an executor is lost),
    ``checkpoint`` (written to the shared checkpoint folder, lineage cut) or ``none``."""
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    return df


def drop_unlabelled(df: DataFrame, target: str = TARGET_REG) -> DataFrame:
    """Rows without the target are dropped."""
    return df.where(F.col(target).isNotNull())


def fit_medians(df: DataFrame, cols=tuple(CHANNELS), method: str = "exact") -> dict:
    q = quantiles(df, list(cols), [0.5], method=method)
    return {c: q[((), c, 0.5)] for c in cols}


def fit_mode(df: DataFrame, col: str = CATEGORY) -> str | None:
    """Most frequent non-null value; ties go to the smallest value (pandas ``mode()[0]``).

    Partial counts per task, then a top-1 (TakeOrdered) over the per-value counts."""
    row = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.asc(col)).limit(1).collect())
    return row[0][col] if row else None


def impute(df: DataFrame, medians: dict, mode: str | None, col: str = CATEGORY) -> DataFrame:
    """Fill channel nulls by their median and the category by its mode."""
    fills = {c: F.coalesce(F.col(c), F.lit(v).cast("double")).alias(c) for c, v in medians.items()}
    fills[col] = F.coalesce(F.col(col), F.lit(mode).cast("string")).alias(col)
    return df.select(*[fills.get(c, F.col(c)) for c in df.columns])


def fit_terciles(df: DataFrame, target: str = TARGET_REG, method: str = "exact") -> tuple:
    q = quantiles(df, [target], [1 / 3, 2 / 3], method=method)
    return q[((), target, 1 / 3)], q[((), target, 2 / 3)]


def with_total_budget(df: DataFrame) -> DataFrame:
    """P5: Total_Budget = TV + Radio + Social_Media (null if any part is null)."""
    return df.withColumn("Total_Budget", F.col("TV") + F.col("Radio") + F.col("Social_Media"))


def with_roi_shares(df: DataFrame) -> DataFrame:
    """ROI and channel shares; a zero total gives null, never a division error."""
    return (df.withColumn("ROI", safe_div("Sales", "Total_Budget"))
              .withColumn("TV_Share", safe_div("TV", "Total_Budget"))
              .withColumn("Radio_Share", safe_div("Radio", "Total_Budget"))
              .withColumn("Social_Share", safe_div("Social_Media", "Total_Budget")))


def performance_label(sales, q1: float, q2: float):
    """Right-closed tercile bins (-inf, q1], (q1, q2], (q2, inf)."""
    s = F.col(sales) if isinstance(sales, str) else sales
    return (F.when(s.isNull(), None).when(s <= F.lit(q1), CLASSES[0])
            .when(s <= F.lit(q2), CLASSES[1]).otherwise(CLASSES[2]))


def with_performance(df: DataFrame, terciles: tuple) -> DataFrame:
    return df.withColumn("Performance", performance_label(TARGET_REG, *terciles))


def fit_prep_stats(labelled: DataFrame, method: str = "exact", target: str = TARGET_REG) -> PrepStats:
    """Channel medians (P3), mode (P4) and target terciles (P7) of the labelled rows.

    Imputation never touches the target nor the row set, so the terciles of the cleaned
    table equal those of the labelled one: medians and terciles share one distributed
    selection (the same passes over the data) instead of one each."""
    if method != "exact":
        return PrepStats(fit_medians(labelled, method=method), fit_mode(labelled),
                         fit_terciles(labelled, target, method=method))
    probs = {**{c: [0.5] for c in CHANNELS}, target: [1 / 3, 2 / 3]}
    q = exact_quantiles(labelled, [*CHANNELS, target], probs)
    return PrepStats({c: q[((), c, 0.5)] for c in CHANNELS}, fit_mode(labelled),
                     (q[((), target, 1 / 3)], q[((), target, 2 / 3)]))


def clean_campaigns(raw: DataFrame, method: str = "exact", stats: PrepStats | None = None,
                    reuse: str = "persist") -> tuple[DataFrame, PrepStats]:
    """Drop unlabelled rows, impute over all labelled rows (reference order)."""
    labelled = materialize(drop_unlabelled(raw), reuse)
    if stats is None:
        stats = fit_prep_stats(labelled, method=method)
    return impute(labelled, stats.medians, stats.mode), stats


def enrich(clean: DataFrame, stats: PrepStats | None = None, method: str = "exact") -> tuple[DataFrame, PrepStats]:
    """P5-P7 on a cleaned table; terciles fitted on it unless given."""
    terc = stats.terciles if stats and stats.terciles[0] is not None else fit_terciles(clean, method=method)
    if stats is not None:
        stats.terciles = terc
    out = with_performance(with_roi_shares(with_total_budget(clean)), terc)
    return out, stats or PrepStats({}, None, terc)


def prepare(raw: DataFrame, method: str = "exact", reuse: str = "persist") -> tuple[DataFrame, PrepStats]:
    """Clean + enrich: the enriched campaign table ``camp``."""
    clean, stats = clean_campaigns(raw, method=method, reuse=reuse)
    camp, stats = enrich(clean, stats, method=method)
    return camp, stats


def select_xy(df: DataFrame, task: str = "regression", key: str = KEY) -> DataFrame:
    """Key, the four raw features and the target of the task (the class as text)."""
    target = F.col(TARGET_REG) if task == "regression" else F.col("Performance").cast("string")
    name = TARGET_REG if task == "regression" else "Performance"
    return df.select(key, *CHANNELS, CATEGORY, target.alias(name))


ENRICHED_COLUMNS = [KEY, *CHANNELS, CATEGORY, TARGET_REG, "Total_Budget", "ROI", "TV_Share",
                    "Radio_Share", "Social_Share", "Performance"]
