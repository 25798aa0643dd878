"""Cross-validation of closed-form predictors from per-fold aggregates.

All k leave-one-fold-out fits come from one pass of conditional ``regr_*`` aggregates
(a fold's rows are nulled out of its own fit), and all k fold scores from a second
pass grouped by fold: two scans for the whole CV, whatever k.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import rnd, safe_div
from ..schema import CHANNELS, TARGET_REG


def cv_trend_scores(train: DataFrame, feature: str, name: str, k: int = 5, target: str = TARGET_REG,
                    fold: str = "fold") -> DataFrame:
    """R² of a one-feature least-squares line on each held-out fold: (model, fold, score)."""
    aggs = []
    for f in range(k):
        keep = F.col(fold) != F.lit(f)
        y, x = F.when(keep, F.col(target)), F.when(keep, F.col(feature))
        aggs += [F.regr_intercept(y, x).alias(f"a{f}"), F.regr_slope(y, x).alias(f"b{f}")]
    fits = train.agg(*aggs).first()
    pred = F.lit(None).cast("double")
    for f in range(k):
        pred = F.when(F.col(fold) == F.lit(f), F.lit(fits[f"a{f}"]) + F.lit(fits[f"b{f}"]) * F.col(feature)).otherwise(pred)
    e = F.col(target) - pred
    per = train.groupBy(fold).agg(F.sum(e * e).alias("sse"), (F.var_pop(target) * F.count(F.lit(1))).alias("sst"))
    return per.select(F.lit(name).alias("model"), F.col(fold).alias("fold"),
                      rnd(F.lit(1.0) - safe_div("sse", "sst"), 6).alias("score"))


def learning_curve_trend(train: DataFrame, feature: str, name: str, sizes: int = 8, k: int = 5,
                         seed: int = 43, target: str = TARGET_REG, fold: str = "fold") -> DataFrame:
    """E9 for a one-feature least-squares line: train and validation R² by training size.

    For every fold f and fraction s of ``linspace(0.2, 1, sizes)`` the fit uses the rows
    with ``fold != f`` whose hash draw is below s (so smaller subsets nest in larger
    ones).  All k x sizes fits are conditional aggregates of one pass; every row is then
    expanded to the (f, s) cells it belongs to and all scores come from one aggregation.
    Output: (model, size_idx, fraction, n_train, train_mean, train_std, val_mean, val_std).
    """
    import numpy as np

    from ..functions.exprs import hash_unit

    fracs = [float(x) for x in np.linspace(0.2, 1.0, sizes)]
    t = train.withColumn("__u", hash_unit("campaign_id", seed))
    aggs = []
    for f in range(k):
        for i, s in enumerate(fracs):
            keep = (F.col(fold) != F.lit(f)) & (F.col("__u") < F.lit(s))
            y, x = F.when(keep, F.col(target)), F.when(keep, F.col(feature))
            aggs += [F.regr_intercept(y, x).alias(f"a{f}_{i}"), F.regr_slope(y, x).alias(f"b{f}_{i}")]
    fits = t.agg(*aggs).first()
    cells = []
    for f in range(k):
        for i, s in enumerate(fracs):
            pred = F.lit(fits[f"a{f}_{i}"]) + F.lit(fits[f"b{f}_{i}"]) * F.col(feature)
            in_train = (F.col(fold) != F.lit(f)) & (F.col("__u") < F.lit(s))
            cells.append(F.when(in_train, F.struct(F.lit(f).alias("f"), F.lit(i).alias("i"), F.lit("train").alias("kind"),
                                                   pred.alias("p"))))
            cells.append(F.when(F.col(fold) == F.lit(f), F.struct(F.lit(f).alias("f"), F.lit(i).alias("i"),
                                                                  F.lit("val").alias("kind"), pred.alias("p"))))
    exp = t.select(target, F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("c"))
    e = F.col(target) - F.col("c.p")
    per = exp.groupBy(F.col("c.f").alias("f"), F.col("c.i").alias("i"), F.col("c.kind").alias("kind")).agg(
        (F.lit(1.0) - safe_div(F.sum(e * e), F.var_pop(target) * F.count(F.lit(1)))).alias("r2"),
        F.count(F.lit(1)).alias("n"))
    wide = per.groupBy("i").agg(
        F.avg(F.when(F.col("kind") == "train", F.col("n"))).alias("n_train"),
        F.avg(F.when(F.col("kind") == "train", F.col("r2"))).alias("train_mean"),
        F.stddev_pop(F.when(F.col("kind") == "train", F.col("r2"))).alias("train_std"),
        F.avg(F.when(F.col("kind") == "val", F.col("r2"))).alias("val_mean"),
        F.stddev_pop(F.when(F.col("kind") == "val", F.col("r2"))).alias("val_std"))
    frac = F.element_at(F.array(*[F.lit(x) for x in fracs]), F.col("i") + 1)
    return wide.select(F.lit(name).alias("model"), F.col("i").alias("size_idx"), frac.alias("fraction"),
                       rnd("n_train", 6).alias("n_train"), *[rnd(c, 6).alias(c) for c in
                                                             ["train_mean", "train_std", "val_mean", "val_std"]])


# Subsets that sums of products decide: features' correlations of at most this condition, squares of at least this share
# of what they are before the mean is taken off.
CONDITION, SPREAD = 1e8, 1e-6


def _least_squares(estimator, target: str) -> bool:
    """Whether a fit is plain least squares with an intercept, so that sums of products decide it."""
    return (isinstance(estimator, LinearRegression) and estimator.getRegParam() == 0.0 and estimator.getLoss() == "squaredError"
            and estimator.getFitIntercept() and estimator.getSolver() == "normal" and estimator.getLabelCol() == target
            and not estimator.isDefined(estimator.weightCol))


def least_squares_scores(drawn: DataFrame, fracs: list[float], cells: list[tuple[int, int]], target: str) -> tuple[list[dict], list]:
    """R² and rows of the training and validation side of every (fold, size), and the cells that sums cannot decide.

    One aggregation adds up the products of features and target by fold and by the smallest size that holds a row.  The
    sums of a subset are those of its folds and sizes together; they give its scaling, its line and the squared errors of
    either side.  Subsets without rows, with missing values or with dependent features are left to the estimator.
    """
    from .features import feature_names, onehot_features

    names = [*feature_names(), target]
    m = len(names)
    wide = onehot_features(drawn)
    middle = drawn.select(*[F.avg(c).alias(c) for c in [*CHANNELS, target]]).first()
    missing = F.lit(float("nan"))
    z = [F.coalesce(F.col(c).cast("double"), missing) - F.lit(float(middle[c] or 0.0) if c in middle else 0.0) for c in names]
    size = F.coalesce(sum([(F.col("draw") >= F.lit(s)).cast("int") for s in fracs], F.lit(0)), F.lit(len(fracs)))
    pairs = [(a, b) for a in range(m) for b in range(a, m)]
    found = wide.select("fold", size.alias("size"), *[c.alias(f"z{a}") for a, c in enumerate(z)]).groupBy("fold", "size").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"z{a}").alias(f"s{a}") for a in range(m)],
        *[e for a in range(m) for e in (F.min(f"z{a}").alias(f"low{a}"), F.max(f"z{a}").alias(f"high{a}"))],
        *[F.sum(F.col(f"z{a}") * F.col(f"z{b}")).alias(f"p{a}_{b}") for a, b in pairs]).collect()  # folds x sizes rows
    sums = [(r["fold"], r["size"], _Sums.of(r, pairs, m)) for r in found]
    scores, left = [], []
    for f, i in cells:
        fitted = _Sums.together([s for fold, at, s in sums if fold is not None and fold != f and at <= i], m)
        sides = {"train": _Sums.together([s for fold, at, s in sums if fold != f and at <= i], m),
                 "val": _Sums.together([s for fold, at, s in sums if fold == f], m)}
        line = fitted.line() if all(s.n == 0 or s.sure(m - 1) for s in sides.values()) else None
        if line is None:
            left.append((f, i))
            continue
        scores += [{"i": i, "kind": kind, "n": s.n, "r2": s.r2(*line)} for kind, s in sides.items() if s.n]
    return scores, left


@dataclass
class _Sums:
    """Rows, and sums, products and ranges of the features and the target (last)."""
    n: int
    total: np.ndarray
    raw: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, row, pairs: list[tuple[int, int]], m: int) -> "_Sums":
        raw = np.zeros((m, m))
        for a, b in pairs:
            raw[a, b] = raw[b, a] = row[f"p{a}_{b}"]
        total, low, high = (np.array([row[f"{name}{a}"] for a in range(m)]) for name in ("s", "low", "high"))
        return cls(row["n"], total, raw, low, high)

    @classmethod
    def together(cls, parts: list["_Sums"], m: int) -> "_Sums":
        out = cls(0, np.zeros(m), np.zeros((m, m)), np.full(m, np.inf), np.full(m, -np.inf))
        for s in parts:
            out = cls(out.n + s.n, out.total + s.total, out.raw + s.raw, np.minimum(out.low, s.low), np.maximum(out.high, s.high))
        return out

    @property
    def mean(self) -> np.ndarray:
        return self.total / self.n

    @property
    def products(self) -> np.ndarray:
        """Products of the distances from the means."""
        return self.raw - self.n * np.outer(self.mean, self.mean)

    def sure(self, a: int) -> bool:
        """Whether a column is constant, or spread enough that its squares are known to many digits; nothing is missing."""
        return bool(np.isfinite(self.raw).all()) and (self.low[a] == self.high[a] or self.products[a, a] >= SPREAD * self.raw[a, a])

    def line(self) -> tuple[float, np.ndarray] | None:
        """Intercept and slopes of least squares, features scaled by their spread; a constant feature has slope 0.

        None without rows, with missing values, or if the features depend on each other."""
        m = len(self.total) - 1
        if not self.n or not all(self.sure(a) for a in range(m + 1)):
            return None
        slopes, used = np.zeros(m), np.flatnonzero(self.low[:m] < self.high[:m])
        if len(used):
            spread = np.sqrt(np.diag(self.products)[used])
            related = self.products[np.ix_(used, used)] / np.outer(spread, spread)
            if np.linalg.cond(related) > CONDITION:
                return None
            slopes[used] = np.linalg.solve(related, self.products[used, m] / spread) / spread
        return float(self.mean[m] - slopes @ self.mean[:m]), slopes

    def r2(self, intercept: float, slopes: np.ndarray) -> float | None:
        if self.low[-1] == self.high[-1]:
            return None
        weights = np.append(-slopes, 1.0)  # error = target - slopes . features - intercept
        squared = weights @ self.products @ weights + self.n * (weights @ self.mean - intercept) ** 2
        return float(1.0 - max(0.0, squared) / self.products[-1, -1])


def learning_curve(train: DataFrame, estimator, name: str, sizes: int = 8, k: int = 5, seed: int = 43,
                   target: str = TARGET_REG, parallelism: int = 8) -> DataFrame:
    """E9 of a fitted pipeline: train and validation R² by training size, in the columns of ``learning_curve_trend``.

    The subsets are nested: a row's hash draw gives the smallest size that holds it, so all sizes share one compact
    table and a size is a range filter on ``draw``; nothing is sampled or sorted.  Least-squares fits and their
    scores come from sums of products by (fold, size), added up in one pass; other fits run in one pool, and the
    scores of all of them come from one aggregation of (fold, size, side) error sums.
    """
    import functools

    from ..functions.exprs import hash_unit
    from .train import compact, fit_model, in_pool

    fracs = [float(x) for x in np.linspace(0.2, 1.0, sizes)]
    drawn = train.withColumn("draw", hash_unit("campaign_id", seed))
    cells = [(f, i) for i in reversed(range(sizes)) for f in range(k)]  # the largest first
    per = []
    if _least_squares(estimator, target):
        per, cells = least_squares_scores(drawn, fracs, cells, target)
    data = compact(drawn) if cells else None

    def one(f, i):
        rest = data.where((F.col("fold") != f) & (F.col("draw") < fracs[i]))
        model, _ = fit_model(rest, estimator.copy(), "regression")
        e = F.col(target) - F.col("prediction")
        side = F.when(F.col("fold") == f, "val").otherwise("train")
        seen = data.where((F.col("fold") == f) | (F.col("draw") < fracs[i]))
        return model.predict(seen).groupBy(side.alias("kind")).agg(
            (F.lit(1.0) - safe_div(F.sum(e * e), F.var_pop(target) * F.count(F.lit(1)))).alias("r2"),
            F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "kind", "r2", "n")

    if cells:
        parts = in_pool([functools.partial(one, *c) for c in cells], parallelism)
        per += [r.asDict() for r in functools.reduce(DataFrame.unionByName, parts).collect()]  # two rows per fit
        data.unpersist()
    out = []
    for i, s in enumerate(fracs):
        side = lambda kind, c: [float(r[c]) for r in per if r["i"] == i and r["kind"] == kind and r[c] is not None]  # noqa: B023, E731
        sides = [f(side(kind, "r2")) if side(kind, "r2") else None for kind in ("train", "val") for f in (np.mean, np.std)]
        out.append((name, i, s, float(np.mean(side("train", "n"))), *[None if v is None else float(v) for v in sides]))
    frame = train.sparkSession.createDataFrame(out, "model string, size_idx int, fraction double, n_train double, "
                                                    "train_mean double, train_std double, val_mean double, val_std double")
    return frame.select("model", "size_idx", "fraction", *[rnd(c, 6).alias(c) for c in frame.columns[3:]])


def cv_raw_trend_scores(train: DataFrame, feature: str, name: str, k: int = 5, parallelism: int = 8) -> DataFrame:
    """K6 over raw campaigns: each fold's line is fitted, and its rows filled, by the statistics of the other folds.

    The fits run in one pool; the scores of all folds come from one aggregation."""
    import functools

    from .evaluate import regression_metrics
    from .predictors import TrendModel, predictions
    from .preparer import CampaignPreparer
    from .train import compact, in_pool

    data = compact(train)

    def one(f):
        rest = data.where(F.col("fold") != f)
        prepared = CampaignPreparer().fit(rest)
        line = TrendModel.fit(prepared.transform(rest), feature)
        held = prepared.transform(data.where(F.col("fold") == f)).withColumn("split", F.lit(str(f)))
        return predictions(held, {name: line})

    parts = in_pool([functools.partial(one, f) for f in range(k)], parallelism)
    found = regression_metrics(functools.reduce(DataFrame.unionByName, parts), ("model", "split"), digits=12).select(
        "model", F.col("split").cast("int").alias("fold"), F.col("r2").alias("score")).collect()  # one row per fold
    data.unpersist()
    return train.sparkSession.createDataFrame(found, "model string, fold int, score double")
