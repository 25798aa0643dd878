"""train/test splits, cross-validation folds and class weights.

All splits are functions of the row key through md5, so they need no shuffle, do not
depend on partitioning or row order, are stable as the table grows, and can be
reproduced by any SQL engine.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import col_, hash_fold, hash_hex, is_test_row, rnd
from ..functions.quantiles import order_statistics
from ..schema import KEY, SEED, TARGET_CLF


def hash_split(df: DataFrame, test_size: float = 0.2, seed: int = SEED, key: str = KEY) -> DataFrame:
    """``split`` = test when the row hash falls below ``test_size`` of the hash range."""
    return df.withColumn("split", F.when(is_test_row(key, test_size, seed), "test").otherwise("train"))


def hash_draw52(key: str = KEY, seed: int = SEED, start: int = 1):
    """A 52-bit draw from the row hash: exact in a double, so order statistics stay exact.

    Draws from hex digits 1-13 and 14-26 (``start``) are independent of each other."""
    return F.conv(F.substring(hash_hex(key, seed), start, 13), 16, 10).cast("long").cast("double")


def stratified_split(df: DataFrame, label: str = TARGET_CLF, test_size: float = 0.2, seed: int = SEED,
                     key: str = KEY) -> DataFrame:
    """per class, exactly ``floor(test_size * n_class + 0.5)`` rows of smallest hash are test.

    The class threshold is the k-th smallest 52-bit hash of the class, found by the
    distributed order statistics of ``functions.quantiles`` (no window holds a class in
    one task).  Rows then compare against a literal per class: one narrow projection.
    Two keys sharing a 52-bit hash at the threshold (chance about n / 2^52) would both go
    to test.
    """
    staged = df.withColumn("__h", hash_draw52(key, seed))
    ks = {}

    def ranks(g, c, n):
        k = int(math.floor(test_size * n + 0.5))
        ks[g] = k
        return [k - 1] if k > 0 else []

    thr = order_statistics(staged.where(F.col(label).isNotNull()), ["__h"], ranks, by=[label],
                           hints={"__h": [test_size]})
    cond = F.lit(False)
    for (g,), k in ks.items():
        if k > 0:
            cond = F.when(F.col(label) == F.lit(g), F.col("__h") <= F.lit(thr[((g,), "__h", k - 1)])).otherwise(cond)
    return staged.withColumn("split", F.when(cond, "test").otherwise("train")).drop("__h")


def with_folds(df: DataFrame, k: int = 5, seed: int = SEED, key: str = KEY) -> DataFrame:
    """fold 0..k-1 from hash digits independent of the split draw."""
    return df.withColumn("fold", hash_fold(key, k, seed))


def stratified_folds(df: DataFrame, label: str = TARGET_CLF, k: int = 5, seed: int = SEED, key: str = KEY) -> DataFrame:
    """F7 for classification: every class is cut at its i * n_class // k-th smallest hashes, so the sizes of a class in
    two folds differ by one row at most.  Rows without a class get no fold.

    The cuts come from the distributed order statistics, as in ``stratified_split``; the draw is independent of its draw.
    """
    staged = df.withColumn("__h", hash_draw52(key, seed, start=14))
    cuts = {}

    def ranks(g, c, n):
        cuts[g] = [i * n // k for i in range(1, k)]
        return sorted(set(cuts[g]))

    at = order_statistics(staged.where(F.col(label).isNotNull()), ["__h"], ranks, by=[label],
                          hints={"__h": [i / k for i in range(1, k)]})
    fold = F.lit(None).cast("int")
    for (g,), rs in cuts.items():
        mine = sum([F.when(F.col("__h") >= F.lit(at[((g,), "__h", r)]), 1).otherwise(0) for r in rs], F.lit(0))
        fold = F.when(F.col(label) == F.lit(g), mine).otherwise(fold)
    return staged.withColumn("fold", fold).drop("__h")


def with_class_weights(df: DataFrame, label: str = TARGET_CLF, weight: str = "weight") -> DataFrame:
    """F8: balanced weights n / (k * n_class); class counts are a small aggregate (one row per class)."""
    counts = {r[label]: r["n"] for r in df.where(F.col(label).isNotNull()).groupBy(label)
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    n, k = sum(counts.values()), len(counts)
    w = F.lit(None).cast("double")
    for c, nc in counts.items():
        w = F.when(F.col(label) == F.lit(c), F.lit(n / (k * nc))).otherwise(w)
    return df.withColumn(weight, w)


def class_weights(df: DataFrame, label: str = TARGET_CLF) -> DataFrame:
    """F8 as a report: class, count, weight."""
    tot = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    agg = tot.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k")).first()
    return tot.select(label, "n", rnd(F.lit(float(agg["total"])) / (F.lit(float(agg["k"])) * col_("n")), 6)
                      .alias("weight"))
