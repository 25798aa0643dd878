"""Metrics and error analysis over the long prediction table.

Every metric is an aggregate grouped by model (and split where needed), so all models
are evaluated in one scan.  Per-class quantities are built from the confusion counts,
a table of at most models x classes x classes rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import rnd, safe_div
from ..schema import CLASSES, KEY


def _by(by):
    return [by] if isinstance(by, str) else list(by)


def regression_metrics(preds: DataFrame, by=("model",), digits: int = 6) -> DataFrame:
    """N, MAE, RMSE and R² = 1 - SSE / SST (SST = n * population variance of the actual)."""
    e = F.col("actual") - F.col("predicted")
    agg = preds.groupBy(*_by(by)).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.sum(e * e).alias("sse"), (F.var_pop("actual") * F.count(F.lit(1))).alias("sst"))
    return agg.select(*_by(by), "n", rnd("mae", digits).alias("mae"), rnd("rmse", digits).alias("rmse"),
                      rnd(F.lit(1.0) - safe_div("sse", "sst"), digits).alias("r2"))


def confusion_counts(preds: DataFrame, by=("model",)) -> DataFrame:
    return preds.groupBy(*_by(by), "actual", "predicted").agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(preds: DataFrame, by=("model",), digits: int = 6) -> DataFrame:
    """Accuracy and support-weighted precision, recall, F1; an undefined ratio counts 0.

    Labels are the union of actual and predicted ones; a label never observed has
    support 0 and so weight 0 (sklearn ``average='weighted'``)."""
    b = _by(by)
    cc = confusion_counts(preds, b)
    true_c = cc.groupBy(*b, F.col("actual").alias("label")).agg(F.sum("n").alias("support"))
    pred_c = cc.groupBy(*b, F.col("predicted").alias("label")).agg(F.sum("n").alias("n_pred"))
    tp = cc.where(F.col("actual") == F.col("predicted")).select(*b, F.col("actual").alias("label"), F.col("n").alias("tp"))
    per = (true_c.join(pred_c, [*b, "label"], "full").join(tp, [*b, "label"], "left")
           .select(*b, "label", F.coalesce("support", F.lit(0)).alias("support"),
                   F.coalesce("n_pred", F.lit(0)).alias("n_pred"), F.coalesce("tp", F.lit(0)).alias("tp")))
    prec = F.coalesce(safe_div(F.col("tp").cast("double"), F.col("n_pred").cast("double")), F.lit(0.0))
    rec = F.coalesce(safe_div(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    f1 = F.coalesce(safe_div(F.lit(2.0) * prec * rec, prec + rec), F.lit(0.0))
    agg = per.groupBy(*b).agg(
        F.sum("support").alias("n"), F.sum("tp").alias("correct"),
        F.sum(prec * F.col("support")).alias("wp"), F.sum(rec * F.col("support")).alias("wr"),
        F.sum(f1 * F.col("support")).alias("wf"))
    n = F.col("n").cast("double")
    return agg.select(*b, "n", rnd(F.col("correct") / n, digits).alias("accuracy"),
                      rnd(F.col("wp") / n, digits).alias("precision"), rnd(F.col("wr") / n, digits).alias("recall"),
                      rnd(F.col("wf") / n, digits).alias("f1"))


AUC_BUCKET_ROWS = 100_000  # distinct scores per window partition, at most (approximately)


def roc_auc_ovr(preds: DataFrame, by=("model",), classes=tuple(CLASSES), digits: int = 6,
                bucket_rows: int = AUC_BUCKET_ROWS) -> DataFrame:
    """One-vs-rest ROC AUC per class (ties count one half), weighted by class frequency.

    Rows are first reduced to (model, class, score) with positive / negative counts.  The
    negatives below each score = negatives of all lower score buckets (a window over the
    bucket totals, B rows per model and class) + earlier negatives of the same bucket (a
    window per bucket).  Buckets are equal-frequency ranges of the distinct scores, B sized
    from an approximate distinct count so that no window partition holds more than about
    ``bucket_rows`` scores.  A class without positives or negatives makes the AUC undefined
    (null), as the reference skips it.
    """
    b = _by(by)
    long = preds.select(*b, "actual", F.explode(F.array(*[
        F.struct(F.lit(c).alias("cls"), F.col(f"score_{c}").cast("double").alias("score")) for c in classes])).alias("x"))
    g = long.groupBy(*b, F.col("x.cls").alias("cls"), F.col("x.score").alias("score")).agg(
        F.count_if(F.col("actual") == F.col("x.cls")).alias("pos"),
        F.count_if(F.col("actual") != F.col("x.cls")).alias("neg"))
    keys = [*b, "cls"]
    n_distinct = g.groupBy(*keys).agg(F.approx_count_distinct("score").alias("d")).agg(F.max("d")).first()[0] or 0
    n_buckets = max(1, -(-n_distinct // bucket_rows))
    if n_buckets > 1:
        edges = g.groupBy(*keys).agg(F.percentile_approx(
            "score", [i / n_buckets for i in range(1, n_buckets)], 10 * n_buckets).alias("__e"))
        g = g.join(F.broadcast(edges), keys)  # one row per (model, class): bounded
        g = g.withColumn("__bk", F.size(F.filter(F.col("__e"), lambda e: e < F.col("score")))).drop("__e")
    else:
        g = g.withColumn("__bk", F.lit(0))
    tot = g.groupBy(*keys, "__bk").agg(F.sum("neg").alias("__bn"))
    tot = tot.withColumn("__before", F.coalesce(F.sum("__bn").over(
        Window.partitionBy(*keys).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    w = Window.partitionBy(*keys, "__bk").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    g = (g.withColumn("__in", F.coalesce(F.sum("neg").over(w), F.lit(0)))
         .join(tot.select(*keys, "__bk", "__before"), [*keys, "__bk"])
         .withColumn("below", F.col("__before") + F.col("__in")))
    per = g.groupBy(*keys).agg(
        F.sum(F.col("pos") * (F.col("below") + F.col("neg") * 0.5)).alias("u"),
        F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    auc = safe_div(F.col("u"), F.col("p") * F.col("q"))
    return per.groupBy(*b).agg(
        F.when(F.min(F.least("p", "q")) > 0, F.sum(auc * F.col("p")) / F.sum("p")).alias("auc"),
    ).select(*b, rnd("auc", digits).alias("roc_auc"))


def confusion_matrix(preds: DataFrame, by=("model",)) -> DataFrame:
    """Counts over the sorted union of observed and predicted labels, zero filled.

    The label grid is built by exploding the (small, per model) label set, not by a join
    of the prediction table with itself."""
    b = _by(by)
    labels = (preds.select(*b, F.col("actual").alias("l")).unionByName(preds.select(*b, F.col("predicted").alias("l")))
              .where(F.col("l").isNotNull()).groupBy(*b).agg(F.array_sort(F.collect_set("l")).alias("labels")))
    grid = labels.select(*b, F.explode("labels").alias("actual"), "labels").select(
        *b, "actual", F.explode("labels").alias("predicted"))
    return grid.join(confusion_counts(preds, b), [*b, "actual", "predicted"], "left").select(
        *b, "actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def residuals(preds: DataFrame) -> DataFrame:
    """E5: residual per row (actual - predicted), for residual and predicted-vs-actual plots."""
    return preds.select("model", KEY, rnd("actual").alias("actual"), rnd("predicted").alias("predicted"),
                        rnd(F.col("actual") - F.col("predicted")).alias("residual"))


def residual_bounds(preds: DataFrame) -> DataFrame:
    """E5 axis bounds: min and max over actual and predicted, per model."""
    return preds.groupBy("model").agg(rnd(F.least(F.min("actual"), F.min("predicted"))).alias("lo"),
                                      rnd(F.greatest(F.max("actual"), F.max("predicted"))).alias("hi"))


def worst_predictions(preds: DataFrame, features: DataFrame | None = None, n: int = 5) -> DataFrame:
    """The n largest absolute errors of one model's predictions (a top-k report).

    Rounded as the reference: actual, predicted, error to 3 digits, percent error (floor
    1e-6 on |actual|) to 1; sorted by the rounded error, ties by key.  The n rows are then
    joined to their features (broadcast of n rows)."""
    err = F.abs(F.col("actual") - F.col("predicted"))
    top = (preds.select(KEY, "model", rnd("actual", 3).alias("sales_actual"), rnd("predicted", 3).alias("sales_predicted"),
                        rnd(err, 3).alias("abs_error"),
                        rnd(err / F.greatest(F.abs("actual"), F.lit(1e-6)) * 100, 1).alias("pct_error"))
           .orderBy(F.desc("abs_error"), F.asc(KEY)).limit(n))
    if features is None:
        return top
    return features.join(F.broadcast(top), KEY)


def misclassified(preds: DataFrame, features: DataFrame | None = None, n: int = 5) -> DataFrame:
    """The first n wrongly classified rows in key order (a top-k report)."""
    top = (preds.where(F.col("actual") != F.col("predicted"))
           .select(KEY, "model", F.col("actual").alias("class_actual"), F.col("predicted").alias("class_predicted"))
           .orderBy(KEY).limit(n))
    return top if features is None else features.join(F.broadcast(top), KEY)


def extreme_predictions(preds: DataFrame) -> DataFrame:
    """Per model, the row with the lowest and the highest prediction (ties: smallest key)."""
    g = preds.groupBy("model").agg(
        F.min_by(F.struct(KEY, "predicted"), F.struct("predicted", KEY)).alias("lo"),
        F.max_by(F.struct(KEY, "predicted"), F.struct("predicted", (-F.col(KEY)).alias("k"))).alias("hi"))
    return g.select("model", F.explode(F.array(
        F.struct(F.lit("min").alias("extreme"), F.col("lo").getField(KEY).alias(KEY), rnd("lo.predicted").alias("predicted")),
        F.struct(F.lit("max").alias("extreme"), F.col("hi").getField(KEY).alias(KEY), rnd("hi.predicted").alias("predicted")),
    )).alias("x")).select("model", "x.*")


def _gap_table(metric: DataFrame, score: str, names: tuple[str, str]) -> DataFrame:
    tr = metric.where(F.col("split") == "train").select("model", rnd(score, 4).alias(names[0]))
    te = metric.where(F.col("split") == "test").select("model", rnd(score, 4).alias(names[1]))
    return tr.join(te, "model").withColumn("gap", rnd(F.col(names[0]) - F.col(names[1]), 4))


def train_test_gap(preds: DataFrame, task: str = "regression", threshold: float = 0.05) -> DataFrame:
    """Score on train vs test (R² or weighted F1), gap > threshold reads as overfitting."""
    if task == "regression":
        t = _gap_table(regression_metrics(preds, ("model", "split"), digits=12), "r2", ("r2_train", "r2_test"))
    else:
        t = _gap_table(classification_metrics(preds, ("model", "split"), digits=12), "f1", ("f1_train", "f1_test"))
    return t.withColumn("diagnostic", F.when(F.col("gap") > threshold, "overfitting").otherwise("stable"))


def r2_critique(preds: DataFrame, leak: float = -0.01, overfit: float = 0.05) -> DataFrame:
    """Leak suspected when the test score beats train by more than 0.01; overfit above 0.05."""
    t = _gap_table(regression_metrics(preds, ("model", "split"), digits=12), "r2", ("r2_train", "r2_test"))
    return (t.withColumn("leak_suspect", F.when(F.col("gap") < leak, "yes").otherwise("no"))
             .withColumn("overfit", F.when(F.col("gap") > overfit, "yes").otherwise("no")))


def model_comparison(test_preds: DataFrame, cv: DataFrame, task: str = "regression") -> DataFrame:
    """One row per model: test metrics (round 4) and CV mean / population std (round 4)."""
    cvs = cv.groupBy("model").agg(rnd(F.avg("score"), 4).alias("cv_mean"), rnd(F.stddev_pop("score"), 4).alias("cv_std"))
    if task == "regression":
        m = regression_metrics(test_preds, digits=12).select(
            "model", rnd("mae", 4).alias("mae"), rnd("rmse", 4).alias("rmse"), rnd("r2", 4).alias("r2"))
    else:
        m = classification_metrics(test_preds, digits=12).select(
            "model", *[rnd(c, 4).alias(c) for c in ["accuracy", "precision", "recall", "f1"]])
        auc = roc_auc_ovr(test_preds, digits=12).select("model", rnd("roc_auc", 4).alias("roc_auc"))
        m = m.join(auc, "model", "left")
    return m.join(cvs, "model", "left")


def best_model(comparison: DataFrame, metric: str, order: list[str] | None = None) -> DataFrame:
    """The report row of the best model (first in model order on ties)."""
    if order:
        pos = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    else:
        pos = F.col("model")
    return comparison.orderBy(F.desc(metric), pos).limit(1)


def eco_score(runs: DataFrame) -> DataFrame:
    """Eco score = round((1 - t / t_max) * 10, 1) from fit times; advice by score.

    t_max is one scalar aggregate, used as a literal."""
    tmax = runs.agg(F.max("train_time_s")).first()[0] or 0.0
    t = F.col("train_time_s")
    score = rnd((F.lit(1.0) - t / F.lit(tmax if tmax > 0 else 1.0)) * 10, 1)
    return (runs.select("model", "train_time_s", "complexity", "n_params", score.alias("eco_score"))
            .withColumn("advice", F.when(F.col("eco_score") >= 7, "favour")
                        .when(F.col("eco_score") >= 4, "acceptable").otherwise("limit"))
            .orderBy(F.desc("eco_score"), "model"))
