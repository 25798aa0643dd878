"""Named queries: ``(spark, sf_dir) -> DataFrame``, each over the whole driver tables.

``QUERIES`` maps a name to its builder; ``oracle_sql()`` gives the DuckDB text for the
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import rnd
from ..operators import profile as P
from ..operators.lowess import lowess_curve
from ..operators.prepare import ENRICHED_COLUMNS, drop_unlabelled
from ..schema import CHANNELS, KEY
from .context import context, rounded

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def camp(spark, sf_dir) -> DataFrame:
    return context(spark, sf_dir).camp


# ---------------------------------------------------------------- sources and preparation

@query("campaigns_raw")
def q_campaigns_raw(spark, sf):
    return context(spark, sf).raw


@query("clean_campaigns")
def q_clean_campaigns(spark, sf):
    return rounded(camp(spark, sf).select(KEY, *CHANNELS, "Influencer", "Sales"))


@query("enriched_campaigns")
def q_enriched(spark, sf):
    return rounded(camp(spark, sf).select(*ENRICHED_COLUMNS))


# ---------------------------------------------------------------- profiling

@query("null_counts")
def q_null_counts(spark, sf):
    return P.null_counts(context(spark, sf).raw)


@query("table_info")
def q_table_info(spark, sf):
    return P.table_info(camp(spark, sf).select(*ENRICHED_COLUMNS))


@query("first_rows")
def q_first_rows(spark, sf):
    """The first five campaigns."""
    return P.first_rows(rounded(camp(spark, sf).select(*ENRICHED_COLUMNS)))


@query("describe")
def q_describe(spark, sf):
    return P.describe(camp(spark, sf))


@query("value_counts_influencer")
def q_vc_inf(spark, sf):
    return P.value_counts(camp(spark, sf), "Influencer")


@query("value_counts_performance")
def q_vc_perf(spark, sf):
    return P.value_counts(camp(spark, sf), "Performance")


@query("class_balance")
def q_class_balance(spark, sf):
    return P.class_balance(camp(spark, sf))


@query("kpi_overview")
def q_kpi(spark, sf):
    return P.kpi_overview(camp(spark, sf))


@query("channel_mean_budget")
def q_channel_mean(spark, sf):
    return P.channel_mean_budget(camp(spark, sf))


@query("sales_by_influencer")
def q_sales_by_inf(spark, sf):
    return P.sales_by_influencer(camp(spark, sf))


@query("iqr_outliers")
def q_iqr(spark, sf):
    return P.iqr_outliers(camp(spark, sf))


@query("outlier_flags")
def q_outlier_flags(spark, sf):
    cols = [*CHANNELS, "Sales"]
    return P.flag_outliers(camp(spark, sf), cols).select(KEY, *[f"{c}_outlier" for c in cols])


@query("quasi_constant")
def q_quasi(spark, sf):
    return P.quasi_constant(camp(spark, sf)).select(
        "variable", rnd("dominant_value", 6).alias("dominant_value"), "frequency", "quasi_constant")


@query("quasi_constant_columns")
def q_quasi_flagged(spark, sf):
    """Only the columns flagged quasi-constant."""
    return P.quasi_constant_columns(camp(spark, sf)).select(
        "variable", rnd("dominant_value", 6).alias("dominant_value"), "frequency", "quasi_constant")


@query("correlation_matrix")
def q_corr(spark, sf):
    return P.correlation_matrix(camp(spark, sf))


@query("collinear_pairs")
def q_collinear(spark, sf):
    return P.collinear_pairs(camp(spark, sf))


@query("target_correlation")
def q_target_corr(spark, sf):
    return P.target_correlation(camp(spark, sf))


@query("histogram")
def q_histogram(spark, sf):
    return P.histogram(camp(spark, sf), [*CHANNELS, "Sales"], bins=20)


@query("box_stats")
def q_box(spark, sf):
    return P.box_stats(camp(spark, sf))


@query("trend_line")
def q_trend(spark, sf):
    return P.trend_line(camp(spark, sf))


@query("trend_by_influencer")
def q_trend_inf(spark, sf):
    return P.trend_by_group(camp(spark, sf))


@query("channel_roi_long")
def q_channel_roi(spark, sf):
    return rounded(P.channel_roi(camp(spark, sf)))


@query("scatter_points")
def q_scatter(spark, sf):
    return rounded(P.scatter_points(camp(spark, sf)))


@query("saturation_curve")
def q_sat_curve(spark, sf):
    return P.saturation_curve(camp(spark, sf))


@query("saturation_points")
def q_sat_points(spark, sf):
    return P.saturation_points(camp(spark, sf))


@query("lowess_roi")
def q_lowess(spark, sf):
    return lowess_curve(camp(spark, sf))


@query("top_roi")
def q_top_roi(spark, sf):
    return P.top_roi(camp(spark, sf))


def oracle_sql() -> dict[str, str]:
    from .oracle import all_sql
    return {k: v for k, v in all_sql().items() if k in QUERIES}


# ---------------------------------------------------------------- splits, folds, features

from ..operators import evaluate as EV  # noqa: E402
from ..operators import features as FE  # noqa: E402
from ..operators import splits as SP  # noqa: E402
from ..operators.predictors import TercileClassifier, TrendModel, predictions  # noqa: E402
from ..operators.tuning import cv_trend_scores  # noqa: E402

TREND_FEATURES = {"Budget Trend": "Total_Budget", "TV Trend": "TV"}
TERCILE_FEATURES = {"Budget Terciles": "Total_Budget", "TV Terciles": "TV"}


def reg_table(spark, sf) -> DataFrame:
    """Enriched campaigns with the regression split and the CV fold."""
    ctx = context(spark, sf)
    return ctx.get("reg_table", lambda: SP.with_folds(SP.hash_split(ctx.camp)).persist(StorageLevel.MEMORY_AND_DISK))


def clf_table(spark, sf) -> DataFrame:
    ctx = context(spark, sf)
    return ctx.get("clf_table", lambda: SP.with_folds(SP.stratified_split(ctx.camp)).persist(
        StorageLevel.MEMORY_AND_DISK))


def clf_train(spark, sf) -> DataFrame:
    """Training rows of the classification split in stratified folds."""
    return context(spark, sf).get("clf_train", lambda: SP.stratified_folds(
        clf_table(spark, sf).where(F.col("split") == "train")).persist(StorageLevel.MEMORY_AND_DISK))


def trend_models(spark, sf) -> dict:
    ctx = context(spark, sf)

    def build():
        train = reg_table(spark, sf).where(F.col("split") == "train")
        return {name: TrendModel.fit(train, feat) for name, feat in TREND_FEATURES.items()}
    return ctx.get("trend_models", build)


def tercile_models(spark, sf) -> dict:
    ctx = context(spark, sf)

    def build():
        ctx.camp  # noqa: B018  (fits the terciles)
        train = clf_table(spark, sf).where(F.col("split") == "train")
        t1, t2 = ctx.stats.terciles
        return {name: TercileClassifier(TrendModel.fit(train, feat), t1, t2) for name, feat in TERCILE_FEATURES.items()}
    return ctx.get("tercile_models", build)


def reg_preds(spark, sf) -> DataFrame:
    return predictions(reg_table(spark, sf), trend_models(spark, sf), "regression")


def clf_preds(spark, sf) -> DataFrame:
    return predictions(clf_table(spark, sf), tercile_models(spark, sf), "classification")


def test_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("split") == "test")


@query("split_regression")
def q_split_reg(spark, sf):
    return reg_table(spark, sf).select(KEY, "split")


@query("stratified_folds")
def q_stratified_folds(spark, sf):
    return clf_train(spark, sf).select("campaign_id", "Performance", "fold")


@query("split_stratified")
def q_split_strat(spark, sf):
    return clf_table(spark, sf).select(KEY, "Performance", "split")


@query("cv_folds")
def q_cv_folds(spark, sf):
    return reg_table(spark, sf).select(KEY, "split", "fold")


@query("class_weights")
def q_class_weights(spark, sf):
    return SP.class_weights(clf_table(spark, sf).where(F.col("split") == "train"))


@query("scaled_features")
def q_scaled(spark, sf):
    t = reg_table(spark, sf)
    out = FE.scaled_features(t, t.where(F.col("split") == "train"))
    return rounded(out.select(KEY, *[f"{c}_z" for c in CHANNELS]))


@query("onehot_features")
def q_onehot(spark, sf):
    return FE.onehot_features(camp(spark, sf)).select(KEY, "Influencer", "Influencer_Macro", "Influencer_Micro",
                                                       "Influencer_Nano")


# ---------------------------------------------------------------- evaluation (closed-form predictors)

@query("regression_metrics")
def q_reg_metrics(spark, sf):
    return EV.regression_metrics(test_only(reg_preds(spark, sf)))


@query("classification_metrics")
def q_clf_metrics(spark, sf):
    return EV.classification_metrics(test_only(clf_preds(spark, sf)))


@query("roc_auc_ovr")
def q_auc(spark, sf):
    return EV.roc_auc_ovr(test_only(clf_preds(spark, sf)))


@query("confusion_matrix")
def q_confusion(spark, sf):
    return EV.confusion_matrix(test_only(clf_preds(spark, sf)))


@query("residuals")
def q_residuals(spark, sf):
    return EV.residuals(test_only(reg_preds(spark, sf)))


@query("residual_bounds")
def q_residual_bounds(spark, sf):
    return EV.residual_bounds(test_only(reg_preds(spark, sf)))


@query("metric_labels")
def q_metric_labels(spark, sf):
    """Report texts: R² and MAE with four digits, counts with thousands marks."""
    preds = test_only(reg_preds(spark, sf))
    n = preds.groupBy("model").agg(F.count(F.lit(1)).alias("n_rows"))  # one row per model
    return EV.regression_metrics(preds).join(F.broadcast(n), "model").select(
        "model", F.format_string("%.4f", rnd("r2", 4)).alias("r2_text"), F.format_string("%.4f", rnd("mae", 4)).alias("mae_text"),
        F.format_number("n_rows", 0).alias("n_text"))


@query("worst_predictions")
def q_worst(spark, sf):
    p = test_only(reg_preds(spark, sf)).where(F.col("model") == "Budget Trend")
    feats = rounded(camp(spark, sf).select(KEY, *CHANNELS, "Influencer"))
    return EV.worst_predictions(p, feats, n=5)


@query("misclassified")
def q_misclassified(spark, sf):
    p = test_only(clf_preds(spark, sf)).where(F.col("model") == "Budget Terciles")
    feats = rounded(camp(spark, sf).select(KEY, *CHANNELS, "Influencer"))
    return EV.misclassified(p, feats, n=5)


@query("extreme_predictions")
def q_extremes(spark, sf):
    return EV.extreme_predictions(test_only(reg_preds(spark, sf)))


@query("train_test_gap")
def q_gap(spark, sf):
    return EV.train_test_gap(reg_preds(spark, sf))


@query("train_test_gap_classification")
def q_gap_clf(spark, sf):
    return EV.train_test_gap(clf_preds(spark, sf), task="classification")


@query("r2_critique")
def q_r2_critique(spark, sf):
    return EV.r2_critique(reg_preds(spark, sf))


def trend_cv(spark, sf) -> DataFrame:
    train = reg_table(spark, sf).where(F.col("split") == "train")
    parts = [cv_trend_scores(train, feat, name) for name, feat in TREND_FEATURES.items()]
    return parts[0].unionByName(parts[1])


@query("cv_scores")
def q_cv_scores(spark, sf):
    return trend_cv(spark, sf)


@query("model_comparison")
def q_model_comparison(spark, sf):
    return EV.model_comparison(test_only(reg_preds(spark, sf)), trend_cv(spark, sf))


@query("best_model")
def q_best_model(spark, sf):
    comp = EV.model_comparison(test_only(reg_preds(spark, sf)), trend_cv(spark, sf))
    return EV.best_model(comp, "r2", list(TREND_FEATURES))


# ---------------------------------------------------------------- scoring and registry

from ..functions.quantiles import quantiles  # noqa: E402
from ..operators import score as SC  # noqa: E402
from ..sources.campaigns import table  # noqa: E402

# Fixed derivation of what-if requests: market segment of the ordering customer -> model asked for.
SEGMENT_TO_MODEL = {"AUTOMOBILE": "Budget Trend", "BUILDING": "TV Trend", "MACHINERY": "Budget Trend",
                    "HOUSEHOLD": "Gradient Boosting"}  # FURNITURE asks for no model (default)


def scenario_requests(spark, sf) -> DataFrame:
    """One JSON what-if request per order: its campaign budgets and tier, and a model name."""
    cust = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    model = F.lit(None).cast("string")
    for seg, m in SEGMENT_TO_MODEL.items():
        model = F.when(F.col("c_mktsegment") == seg, m).otherwise(model)
    j = context(spark, sf).ordered.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
    body = F.to_json(F.struct(*CHANNELS, "Influencer", model.alias("model")))
    return j.select(F.col(KEY).alias("request_id"), body.alias("body"))


def reg_runs(spark, sf) -> DataFrame:
    """Run table of the closed-form models: task, model, tuned, score (test R² / weighted F1)."""
    r = EV.regression_metrics(test_only(reg_preds(spark, sf))).select(
        F.lit("regression").alias("task"), "model", F.lit(False).alias("tuned"), F.col("r2").alias("score"))
    c = EV.classification_metrics(test_only(clf_preds(spark, sf))).select(
        F.lit("classification").alias("task"), "model", F.lit(False).alias("tuned"), F.col("f1").alias("score"))
    return r.unionByName(c)


def registry(spark, sf) -> DataFrame:
    return SC.model_registry(reg_runs(spark, sf))


def best_reg_model(spark, sf) -> str:
    """Best regression model by test R² (only the regression runs are needed)."""
    ctx = context(spark, sf)

    def build():
        r = EV.regression_metrics(test_only(reg_preds(spark, sf))).select(
            F.lit("regression").alias("task"), "model", F.lit(False).alias("tuned"), F.col("r2").alias("score"))
        return SC.default_model(SC.model_registry(r), "regression", list(TREND_FEATURES)).first()["model"]
    return ctx.get("best_reg", build)


def validated(spark, sf) -> DataFrame:
    """Parsed and validated what-if requests, persisted once per session."""
    ctx = context(spark, sf)

    def build():
        scen = SC.parse_scenarios(scenario_requests(spark, sf))
        return SC.validate_scenarios(scen, list(trend_models(spark, sf)), best_reg_model(spark, sf)).persist(
            StorageLevel.MEMORY_AND_DISK)
    return ctx.get("validated", build)


def accepted(spark, sf) -> DataFrame:
    return validated(spark, sf).where(F.col("reason").isNull())


@query("scenario_parse")
def q_scenario_parse(spark, sf):
    return SC.parse_scenarios(scenario_requests(spark, sf))


@query("scenario_validation")
def q_scenario_validation(spark, sf):
    return SC.scenario_status(validated(spark, sf))


@query("scenario_unknown_model")
def q_scenario_unknown(spark, sf):
    return validated(spark, sf).where(F.col("reason") == "model_not_found").select("request_id", "model", "reason")


@query("scenario_rejected")
def q_scenario_rejected(spark, sf):
    """Every request that is not scored and why: rejected by the rules, or set aside as its prediction failed."""
    failed = SC.score_quarantined(accepted(spark, sf), trend_models(spark, sf))[1]
    return validated(spark, sf).where(F.col("reason").isNotNull()).select("request_id", "model", "reason").unionByName(failed)


@query("score_scenarios")
def q_score(spark, sf):
    return SC.score_scenarios(accepted(spark, sf), trend_models(spark, sf), with_timestamp=False)


@query("scenario_by_model")
def q_by_model(spark, sf):
    return SC.score_all_models(accepted(spark, sf), trend_models(spark, sf))


@query("sensitivity")
def q_sensitivity(spark, sf):
    c = camp(spark, sf)
    med = quantiles(c, CHANNELS, [0.5], by=["Influencer"])
    tiers = sorted({g[0] for (g, _, _) in med})
    rows = [(t, *[med[((t,), ch, 0.5)] for ch in CHANNELS]) for t in tiers]
    scen = spark.createDataFrame(rows, "Influencer string, TV double, Radio double, Social_Media double")
    mx = c.agg(*[F.max(ch).alias(ch) for ch in CHANNELS]).first().asDict()
    model = trend_models(spark, sf)[best_reg_model(spark, sf)]
    return SC.sensitivity(scen, model, mx, points=60)


@query("model_registry")
def q_registry(spark, sf):
    return registry(spark, sf)


@query("model_resolve")
def q_resolve(spark, sf):
    reg = registry(spark, sf)
    res = SC.resolve_models(reg)
    defaults = SC.default_model(reg, "regression", list(TREND_FEATURES)).unionByName(
        SC.default_model(reg, "classification", list(TERCILE_FEATURES)))
    d = defaults.select("task", F.col("model").alias("__d"))
    return res.join(F.broadcast(d), "task", "left").select(  # one row per task
        "task", "model", "tuned", (F.col("model") == F.col("__d")).alias("is_default"))


def _meta(df: DataFrame, task: str, best: str) -> DataFrame:
    counts = df.groupBy().agg(F.count_if(F.col("split") == "train").alias("n_train"),
                              F.count_if(F.col("split") == "test").alias("n_test"))
    kv = counts.select(F.lit(best).alias(f"best_{task}_model"), F.col("n_train").cast("string").alias("n_train"),
                       F.col("n_test").cast("string").alias("n_test"))
    cols = [f"best_{task}_model", "n_train", "n_test"]
    return kv.unpivot([], cols, "key", "value")


@query("metadata_merge")
def q_metadata_merge(spark, sf):
    reg = registry(spark, sf)
    best_r = SC.default_model(reg, "regression", list(TREND_FEATURES)).first()["model"]
    best_c = SC.default_model(reg, "classification", list(TERCILE_FEATURES)).first()["model"]
    left = _meta(reg_table(spark, sf), "reg", best_r)
    right = _meta(clf_table(spark, sf), "clf", best_c)
    return SC.merge_metadata(left, right)


# ---------------------------------------------------------------- explanation (closed-form predictor)

from ..operators import explain as XP  # noqa: E402
from ..operators import train as TR  # noqa: E402
from ..operators.tuning import learning_curve, learning_curve_trend  # noqa: E402


def budget_trend(spark, sf):
    return trend_models(spark, sf)["Budget Trend"]


@query("permutation_importance")
def q_perm(spark, sf):
    test = test_only(reg_table(spark, sf))
    return XP.permutation_importance(budget_trend(spark, sf), test, repeats=30)


def trend_shap(spark, sf) -> DataFrame:
    t = reg_table(spark, sf)
    return XP.shap_linear(budget_trend(spark, sf), test_only(t), t.where(F.col("split") == "train"))


@query("shap_linear")
def q_shap_linear(spark, sf):
    return trend_shap(spark, sf)


@query("shap_extremes")
def q_shap_extremes(spark, sf):
    preds = test_only(reg_preds(spark, sf)).where(F.col("model") == "Budget Trend")
    return XP.shap_extremes(trend_shap(spark, sf), preds)


@query("shap_summary")
def q_shap_summary(spark, sf):
    return XP.shap_summary(trend_shap(spark, sf))


@query("learning_curve")
def q_learning_curve(spark, sf):
    train = reg_table(spark, sf).where(F.col("split") == "train")
    return learning_curve_trend(train, "Total_Budget", "Budget Trend")


# ---------------------------------------------------------------- distributed model fits (pyspark.ml)

# The names of the fitted pipelines, as in ``train``.
REGRESSORS = ["Linear Regression", "Random Forest", "Gradient Boosting"]
CLASSIFIERS = ["Logistic Regression", "Random Forest", "Gradient Boosting", "MLP (Deep Learning)"]


def _fitted(spark, sf, task: str, names: list[str]):
    """Pipelines of these names with the reference's settings and their run table (each fitted once per session)."""
    ctx = context(spark, sf)
    table = reg_table if task == "regression" else clf_table

    def fit(name):
        return TR.train_all(table(spark, sf).where(F.col("split") == "train"), task, cv=False, only=[name])

    parts = [ctx.get(("ml", task, n), lambda n=n: fit(n)) for n in names]
    models = {n: m for found, _, _ in parts for n, m in found.items()}
    return models, functools.reduce(DataFrame.unionByName, [runs for _, runs, _ in parts])


def ml_regression(spark, sf):
    return _fitted(spark, sf, "regression", REGRESSORS)


def ml_classification(spark, sf):
    return _fitted(spark, sf, "classification", CLASSIFIERS)


def ml_regression_cv(spark, sf) -> DataFrame:
    """K6 fold scores of every regression pipeline (5 folds, concurrent fold fits)."""
    ctx = context(spark, sf)

    return ctx.get("ml_reg_cv", lambda: TR.cross_validate_all(
        reg_table(spark, sf).where(F.col("split") == "train"), "regression"))


def ml_classification_cv(spark, sf) -> DataFrame:
    """K6 fold scores (weighted F1) of every classification pipeline on stratified folds."""
    return context(spark, sf).get("ml_clf_cv", lambda: TR.cross_validate_all(clf_train(spark, sf), "classification"))


def _reg_fit_query(name):
    def q(spark, sf):
        models, _ = _fitted(spark, sf, "regression", [name])
        return rounded(predictions(test_only(reg_table(spark, sf)), models))
    return q


def _clf_fit_query(name):
    def q(spark, sf):
        models, _ = _fitted(spark, sf, "classification", [name])
        return rounded(predictions(test_only(clf_table(spark, sf)), models, "classification"))
    return q


for _key, _name in [("fit_linear", "Linear Regression"), ("fit_forest", "Random Forest"),
                    ("fit_gbt", "Gradient Boosting")]:
    QUERIES[_key] = _reg_fit_query(_name)
for _key, _name in [("fit_logistic", "Logistic Regression"), ("fit_forest_clf", "Random Forest"),
                    ("fit_gbt_clf", "Gradient Boosting"), ("fit_mlp_clf", "MLP (Deep Learning)")]:
    QUERIES[_key] = _clf_fit_query(_name)


@query("ml_cv_scores")
def q_ml_cv(spark, sf):
    return rounded(ml_regression_cv(spark, sf))


@query("ml_model_comparison")
def q_ml_comparison(spark, sf):
    models, _ = ml_regression(spark, sf)
    return EV.model_comparison(predictions(test_only(reg_table(spark, sf)), models), ml_regression_cv(spark, sf))


@query("ml_classification_comparison")
def q_ml_clf_comparison(spark, sf):
    models, _ = ml_classification(spark, sf)
    preds = predictions(test_only(clf_table(spark, sf)), models, "classification")
    return EV.model_comparison(preds, ml_classification_cv(spark, sf), "classification")


@query("ml_classification_cv_scores")
def q_ml_clf_cv(spark, sf):
    return rounded(ml_classification_cv(spark, sf))


@query("grid_search")
def q_grid_search(spark, sf):
    return rounded(ml_grid(spark, sf)[1])


@query("eco_score")
def q_eco(spark, sf):
    model, secs, _ = ml_mlp(spark, sf)
    mlp = spark.createDataFrame([("regression", "MLP (Deep Learning)", False, float(secs), model.n_params, "very high")],
                                "task string, model string, tuned boolean, train_time_s double, n_params long, "
                                "complexity string")
    return EV.eco_score(ml_regression(spark, sf)[1].unionByName(mlp))


@query("deployment_cost")
def q_deployment(spark, sf):
    """Cost of every model that the what-if requests ask for."""
    asked = SC.parse_scenarios(scenario_requests(spark, sf)).where(F.col("model").isNotNull())
    return SC.deployment_cost(asked.select(F.lit("regression").alias("task"), "model"))


def _fitted_preds(spark, sf, task: str, names: list[str]) -> DataFrame:
    models, _ = _fitted(spark, sf, task, names)
    return predictions(reg_table(spark, sf) if task == "regression" else clf_table(spark, sf), models, task)


@query("ml_train_test_gap")
def q_ml_gap(spark, sf):
    """E7 of the fitted pipelines."""
    return EV.train_test_gap(_fitted_preds(spark, sf, "regression", REGRESSORS))


@query("ml_r2_critique")
def q_ml_critique(spark, sf):
    """E8 of the fitted pipelines."""
    return EV.r2_critique(_fitted_preds(spark, sf, "regression", REGRESSORS))


@query("ml_residual_bounds")
def q_ml_bounds(spark, sf):
    """E5 of the fitted pipelines."""
    return EV.residual_bounds(test_only(_fitted_preds(spark, sf, "regression", REGRESSORS)))


@query("ml_worst_predictions")
def q_ml_worst(spark, sf):
    """E6 of the fitted boosting pipeline."""
    preds = test_only(_fitted_preds(spark, sf, "regression", ["Gradient Boosting"]))
    return EV.worst_predictions(preds, rounded(camp(spark, sf).select(KEY, *CHANNELS, "Influencer")), n=5)


@query("ml_extreme_predictions")
def q_ml_extremes(spark, sf):
    """W3 of the fitted pipelines."""
    return EV.extreme_predictions(test_only(_fitted_preds(spark, sf, "regression", REGRESSORS)))


@query("ml_confusion_matrix")
def q_ml_confusion(spark, sf):
    """E3 of the fitted logistic and forest classifiers."""
    return EV.confusion_matrix(test_only(_fitted_preds(spark, sf, "classification", CLASSIFIERS[:2])))


@query("ml_train_test_gap_classification")
def q_ml_gap_clf(spark, sf):
    """E7 of the fitted classifiers."""
    return EV.train_test_gap(_fitted_preds(spark, sf, "classification", CLASSIFIERS), task="classification")


@query("feature_importance")
def q_importance(spark, sf):
    models, _ = ml_regression(spark, sf)
    parts = [XP.feature_importance(models[n]).select(F.lit(n).alias("model"), "feature", rnd("importance", 6)
                                                     .alias("importance"))
             for n in ["Random Forest", "Gradient Boosting"]]
    return parts[0].unionByName(parts[1])


@query("shap_forest")
def q_shap_forest(spark, sf):
    models, _ = ml_regression(spark, sf)
    t = reg_table(spark, sf)
    bg = XP.background_sample(t.where(F.col("split") == "train"))
    return XP.shap_exact(models["Random Forest"], test_only(t), bg)


@query("shap_kernel")
def q_shap_kernel(spark, sf):
    """X4 over the encoded features of the fitted linear pipeline, all test rows."""
    models, _ = _fitted(spark, sf, "regression", ["Linear Regression"])
    t = reg_table(spark, sf)
    return XP.shap_kernel(models["Linear Regression"], test_only(t), t.where(F.col("split") == "train"))


@query("ml_permutation_importance")
def q_ml_perm(spark, sf):
    """X2 on the fitted linear and boosting pipelines."""
    models, _ = _fitted(spark, sf, "regression", ["Linear Regression", "Gradient Boosting"])
    test = test_only(reg_table(spark, sf))
    parts = [XP.permutation_importance(m, test).select(F.lit(n).alias("model"), "feature", "importance_mean", "importance_std")
             for n, m in models.items()]
    return functools.reduce(DataFrame.unionByName, parts)


@query("ml_learning_curve")
def q_ml_learning_curve(spark, sf):
    """E9 of the linear pipeline: eight nested training sizes on five folds."""
    train = reg_table(spark, sf).where(F.col("split") == "train")
    return learning_curve(train, TR.regression_estimators()["Linear Regression"], "Linear Regression")


# ---------------------------------------------------------------- statistics of the training rows only

from ..operators.preparer import ENCODED, SCALED, CampaignPreparer, statistics_table  # noqa: E402
from ..operators.tuning import cv_raw_trend_scores  # noqa: E402


def raw_split(spark, sf) -> DataFrame:
    """Labelled, uncleaned campaigns with the split and the fold of their key."""
    return context(spark, sf).get("raw_split", lambda: SP.with_folds(SP.hash_split(
        drop_unlabelled(context(spark, sf).raw))).persist(StorageLevel.MEMORY_AND_DISK))


def train_preparation(spark, sf):
    return context(spark, sf).get("train_preparation", lambda: CampaignPreparer().fit(
        raw_split(spark, sf).where(F.col("split") == "train")))


@query("leak_free_campaigns")
def q_leak_free(spark, sf):
    """All campaigns, cleaned, enriched, scaled and encoded by the statistics of the training rows."""
    out = train_preparation(spark, sf).transform(raw_split(spark, sf))
    return rounded(out.select(*ENRICHED_COLUMNS, "split", *SCALED, *ENCODED))


@query("preparation_shift")
def q_preparation_shift(spark, sf):
    """What the statistics owe to the test rows: fitted on all labelled rows and on the training rows."""
    every = CampaignPreparer().fit(raw_split(spark, sf))
    table = statistics_table({"all_rows": every, "train_rows": train_preparation(spark, sf)}, spark)
    return rounded(table.withColumn("shift", F.col("all_rows") - F.col("train_rows")))


@query("leak_free_metrics")
def q_leak_free_metrics(spark, sf):
    """E1 of the trend lines on campaigns prepared by the training rows alone."""
    ready = train_preparation(spark, sf).transform(raw_split(spark, sf))
    train = ready.where(F.col("split") == "train")
    lines = {name: TrendModel.fit(train, feat) for name, feat in TREND_FEATURES.items()}
    return EV.regression_metrics(test_only(predictions(ready, lines)))


@query("leak_free_cv_scores")
def q_leak_free_cv(spark, sf):
    """K6 with the preparation refitted inside every fold."""
    train = raw_split(spark, sf).where(F.col("split") == "train")
    return rounded(cv_raw_trend_scores(train, "Total_Budget", "Budget Trend"))


@query("ml_leak_free_cv_scores")
def q_ml_leak_free_cv(spark, sf):
    """K6 of the linear pipeline with the preparation as its first stage."""
    train = raw_split(spark, sf).where(F.col("split") == "train")
    return rounded(TR.cross_validate_all(train, "regression", only=["Linear Regression"], raw=True))


# ---------------------------------------------------------------- streaming (L1)

import uuid  # noqa: E402

from ..session import scratch_path  # noqa: E402
from ..streaming.score_stream import read_scored, stream_score  # noqa: E402


@query("stream_score")
def q_stream_score(spark, sf):
    """Requests land as Parquet files in the shared folder; the stream scores them (availableNow)."""
    root = scratch_path(spark, f"stream-score-{uuid.uuid4().hex}")
    src = os.path.join(root, "requests")
    scenario_requests(spark, sf).write.parquet(src)
    q = stream_score(spark, src, trend_models(spark, sf), best_reg_model(spark, sf), os.path.join(root, "out"),
                     os.path.join(root, "checkpoint"), with_timestamp=False)
    q.awaitTermination()
    return read_scored(spark, os.path.join(root, "out"))


# ---------------------------------------------------------------- batch run (its tables and reports; fits are queries above)

from . import batch as B  # noqa: E402


@query("batch_outputs")
def q_batch_outputs(spark, sf):
    """Loads, cleans, explores and splits in a run of its own; every table it wrote with its rows."""
    run = B.run_batch(spark, scratch_path(spark, "runs"), uuid.uuid4().hex, B.Settings(sf), B.TABLE_STEPS)
    return B.manifest_table(run, B.TABLE_STEPS)


# ---------------------------------------------------------------- K4: neural regressor (data-parallel Adam)

from ..operators.mlp import fit_mlp_regressor  # noqa: E402

MLP_EPOCHS, MLP_PATIENCE = 1000, 20  # fixed values: the reference's settings


def ml_mlp(spark, sf):
    ctx = context(spark, sf)

    def build():
        return fit_mlp_regressor(reg_table(spark, sf).where(F.col("split") == "train"), max_epochs=MLP_EPOCHS,
                                 patience=MLP_PATIENCE)
    return ctx.get("ml_mlp", build)


@query("fit_mlp_reg")
def q_fit_mlp(spark, sf):
    model, _, _ = ml_mlp(spark, sf)
    return rounded(predictions(test_only(reg_table(spark, sf)), {"MLP (Deep Learning)": model}))


from ..operators.treeshap import shap_tree  # noqa: E402


@query("shap_tree")
def q_shap_tree(spark, sf):
    """Path-dependent Tree SHAP of the boosting regressor over all test rows."""
    models, _ = ml_regression(spark, sf)
    return shap_tree(models["Gradient Boosting"], test_only(reg_table(spark, sf)))


# ---------------------------------------------------------------- registry summaries and labels

@query("model_info")
def q_model_info(spark, sf):
    return SC.model_info(registry(spark, sf))


@query("feature_labels")
def q_feature_labels(spark, sf):
    """P14 on the impurity importances of the fitted ensembles (encoded feature names)."""
    return SC.label_features(q_importance(spark, sf))


def ml_grid(spark, sf):
    ctx = context(spark, sf)
    return ctx.get("ml_grid", lambda: TR.grid_search(reg_table(spark, sf).where(F.col("split") == "train")))


@query("ml_model_resolve")
def q_ml_resolve(spark, sf):
    """S5/G6 on the fitted pipelines: the tuned boosting model replaces the base one of the same name."""
    models, _ = ml_regression(spark, sf)
    tuned, _ = ml_grid(spark, sf)
    test = test_only(reg_table(spark, sf))
    base = EV.regression_metrics(predictions(test, models)).select(
        F.lit("regression").alias("task"), "model", F.lit(False).alias("tuned"), F.col("r2").alias("score"))
    tun = EV.regression_metrics(predictions(test, {"Gradient Boosting": tuned})).select(
        F.lit("regression").alias("task"), "model", F.lit(True).alias("tuned"), F.col("r2").alias("score"))
    reg = SC.model_registry(base.unionByName(tun))
    return SC.resolve_models(reg)


# Queries that fit pipelines with the reference's settings, quicker ones first.
LONG = ["fit_linear", "ml_leak_free_cv_scores", "shap_kernel", "ml_learning_curve", "fit_logistic", "fit_gbt", "ml_permutation_importance", "fit_forest", "feature_importance", "feature_labels", "shap_forest",
        "ml_worst_predictions", "ml_train_test_gap", "ml_r2_critique", "ml_residual_bounds", "ml_extreme_predictions",
        "ml_confusion_matrix", "ml_train_test_gap_classification",
        "fit_mlp_clf", "fit_forest_clf", "fit_gbt_clf", "fit_mlp_reg", "eco_score", "shap_tree", "ml_cv_scores",
        "ml_model_comparison", "grid_search", "ml_model_resolve", "ml_classification_cv_scores",
        "ml_classification_comparison"]
