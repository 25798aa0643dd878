"""The batch run: campaigns in; cleaned tables, reports, models, attributions and metadata out.  It can be resumed.

A run is a list of named steps under ``<root>/<run id>/``.  A step reads only what earlier steps have written, never
their objects; it writes its tables and models, and is committed last, by one record in the run's manifest.  A restart
under the same run id skips the committed steps and repeats the one that was under way, whose half-written output is
overwritten: a driver lost in the middle costs at most one step, and the fits of each model are steps of their own.

The settings and the size of the input stand in the manifest too; a restart with others is refused, since its steps
would not belong together.  A record that cannot be read counts as none.  A run id belongs to one driver at a time.

    python -m mixcast.plans.batch --orders /data/sf --out /shared/runs --run-id spring
    python -m mixcast.plans.batch --campaigns /data/campaigns.csv --out /shared/runs --run-id spring --fit-on train
"""

from __future__ import annotations

import argparse
import functools
import json
import os
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators import explain as XP
from ..operators import profile as P
from ..operators import score as SC
from ..operators import splits as SP
from ..operators import train as TR
from ..operators.lowess import lowess_curve
from ..operators.predictors import predictions
from ..operators.prepare import ENRICHED_COLUMNS, drop_unlabelled, prepare
from ..operators.preparer import CampaignPreparer
from ..operators.treeshap import shap_tree
from ..operators.tuning import learning_curve
from ..schema import CATEGORY, CHANNELS, KEY
from ..sources import sinks
from ..sources.campaigns import campaigns_from_orders, read_campaigns

TUNED = "Gradient Boosting tuned"


@dataclass(frozen=True)
class Settings:
    """What a run does; equal settings give equal runs."""
    source: str
    kind: str = "orders"  # or csv, parquet
    fit_on: str = "all"  # the rows that cleaning statistics come from, as in the reference; or train
    profile: str = "reference"
    regressors: tuple[str, ...] = ("Linear Regression", "Random Forest", "Gradient Boosting")
    classifiers: tuple[str, ...] = ("Logistic Regression", "Random Forest", "Gradient Boosting", "MLP (Deep Learning)")
    grid: dict = field(default_factory=lambda: dict(TR.GRID))
    folds: int = 5


@dataclass
class Output:
    """What a step leaves: tables by name, fitted pipelines by (task, name), and facts for the metadata."""
    tables: dict[str, DataFrame] = field(default_factory=dict)
    models: dict[tuple[str, str], object] = field(default_factory=dict)
    facts: dict = field(default_factory=dict)


Step = tuple[str, Callable[["Run"], Output]]


class Run:
    """One run's folder, settings and manifest."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, settings: Settings):
        self.spark, self.settings = spark, settings
        self.folder = os.path.join(root, run_id)
        self.executed: list[str] = []  # steps done by this driver
        files, size = sinks.content_summary(spark, settings.source)
        wanted = json.loads(json.dumps({**asdict(settings), "input_files": files, "input_bytes": size}))
        known = self._record("settings")
        if known is None:
            sinks.write_text(spark, self._at("settings"), json.dumps(wanted, sort_keys=True))
        elif known != wanted:
            odd = sorted(k for k in wanted.keys() | known.keys() if known.get(k) != wanted.get(k))
            raise ValueError(f"run {run_id!r} was started with other settings: {', '.join(odd)}")

    def _at(self, name: str) -> str:
        return os.path.join(self.folder, "_manifest", f"{name}.json")

    def _record(self, name: str) -> dict | None:
        text = sinks.read_text(self.spark, self._at(name))
        try:
            return None if text is None else json.loads(text)
        except json.JSONDecodeError:
            return None  # cut off while it was written

    def committed(self, step: str) -> dict | None:
        """The record of a finished step."""
        return self._record(step)

    def table(self, step: str, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, step, name))

    def models(self, task: str, names) -> dict:
        return sinks.load_models(task, list(names), os.path.join(self.folder, "models"))

    def fact(self, step: str, name: str):
        return self.committed(step)["facts"][name]

    def execute(self, steps: list[Step]) -> list[dict]:
        """Runs the steps that are not committed, in order; the records of all."""
        for name, build in steps:
            if self.committed(name) is None:
                self._execute(name, build)
        return [self.committed(name) for name, _ in steps]

    def _execute(self, name: str, build: Callable[[Run], Output]) -> None:
        started = datetime.now(UTC).isoformat()
        out = build(self)
        rows = {}
        for table, df in out.tables.items():
            sinks.write_report(df, os.path.join(self.folder, name), table)
            rows[table] = self.table(name, table).count()
        for (task, model), fitted in out.models.items():
            sinks.save_models({model: fitted}, task, os.path.join(self.folder, "models"))
        record = {"step": name, "tables": rows, "models": [list(k) for k in out.models], "facts": out.facts,
                  "started": started, "ended": datetime.now(UTC).isoformat()}
        sinks.write_text(self.spark, self._at(name), json.dumps(record, sort_keys=True, default=str))
        self.executed.append(name)


# ---------------------------------------------------------------- tables and reports

def _load(run: Run) -> Output:
    s = run.settings
    raw = (campaigns_from_orders(run.spark, s.source) if s.kind == "orders"
           else read_campaigns(run.spark, s.source, s.kind))
    return Output({"raw": raw})


def _prepare(run: Run) -> Output:
    raw = run.table("load", "raw")
    if run.settings.fit_on == "train":
        rows = SP.hash_split(drop_unlabelled(raw))
        model = CampaignPreparer().fit(rows.where(F.col("split") == "train"))
        return Output({"campaigns": model.transform(rows).select(*ENRICHED_COLUMNS)}, facts=model.statistics)
    camp, stats = prepare(raw, reuse="none")
    return Output({"campaigns": camp.select(*ENRICHED_COLUMNS)},
                  facts={"medians": stats.medians, "mode": stats.mode, "terciles": list(stats.terciles)})


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "describe": P.describe,
    "value_counts_influencer": lambda c: P.value_counts(c, CATEGORY),
    "class_balance": P.class_balance,
    "kpi_overview": P.kpi_overview,
    "channel_mean_budget": P.channel_mean_budget,
    "sales_by_influencer": P.sales_by_influencer,
    "iqr_outliers": P.iqr_outliers,
    "quasi_constant": P.quasi_constant,
    "correlation_matrix": P.correlation_matrix,
    "collinear_pairs": P.collinear_pairs,
    "target_correlation": P.target_correlation,
    "histogram": lambda c: P.histogram(c, [*CHANNELS, "Sales"], bins=20),
    "box_stats": P.box_stats,
    "trend_by_influencer": P.trend_by_group,
    "saturation_curve": P.saturation_curve,
    "saturation_points": P.saturation_points,
    "lowess_roi": lowess_curve,
    "top_roi": P.top_roi,
}


def _explore(run: Run) -> Output:
    camp = run.table("prepare", "campaigns").persist()
    return Output({"null_counts": P.null_counts(run.table("load", "raw")), **{n: f(camp) for n, f in REPORTS.items()}})


def _split(run: Run) -> Output:
    camp = run.table("prepare", "campaigns")
    k = run.settings.folds
    clf = SP.stratified_split(camp)
    return Output({"regression": SP.with_folds(SP.hash_split(camp), k=k), "classification": clf,
                   "classification_train": SP.stratified_folds(clf.where(F.col("split") == "train"), k=k)})


def train_rows(run: Run, task: str) -> DataFrame:
    return (run.table("split", "classification_train") if task == "classification"
            else run.table("split", "regression").where(F.col("split") == "train"))


# ---------------------------------------------------------------- models

def _fit(run: Run, task: str, name: str) -> Output:
    models, runs, _ = TR.train_all(train_rows(run, task), task, run.settings.profile, cv=False, only=[name])
    return Output({"run": runs}, {(task, name): models[name]})


def _cross_validate(run: Run, task: str, name: str) -> Output:
    return Output({"scores": TR.cross_validate_all(train_rows(run, task), task, run.settings.profile, run.settings.folds,
                                                   only=[name])})


def _tune(run: Run) -> Output:
    model, table = TR.grid_search(train_rows(run, "regression"), k=run.settings.folds, grid=run.settings.grid)
    best = table.orderBy(F.desc("cv_mean"), "settings").first()
    return Output({"grid": table}, {("regression", TUNED): model},
                  {"gs_best_params": best["settings"], "gs_best_score": round(best["cv_mean"], 4)})


def names_of(run: Run, task: str) -> tuple[str, ...]:
    return run.settings.regressors if task == "regression" else run.settings.classifiers


def _predict(run: Run, task: str) -> Output:
    names = names_of(run, task) + ((TUNED,) if task == "regression" else ())
    return Output({"predictions": predictions(run.table("split", task), run.models(task, names), task)})


def _together(run: Run, prefix: str, task: str, table: str) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, [run.table(f"{prefix} {task} {n}", table) for n in names_of(run, task)])


def _report_regression(run: Run) -> Output:
    preds = run.table("predict regression", "predictions").persist()
    test = preds.where(F.col("split") == "test")
    base = test.where(F.col("model") != TUNED)
    comparison = EV.model_comparison(base, _together(run, "cross-validate", "regression", "scores"))
    best = EV.best_model(comparison, "r2", list(run.settings.regressors)).first()["model"]
    found = run.models("regression", run.settings.regressors)
    held = run.table("split", "regression").where(F.col("split") == "test")
    ests = TR.regression_estimators(run.settings.profile)
    out = {
        "comparison": comparison, "tuned_metrics": EV.regression_metrics(test.where(F.col("model") == TUNED)),
        "gap": EV.train_test_gap(preds), "critique": EV.r2_critique(preds), "residual_bounds": EV.residual_bounds(test),
        "worst": EV.worst_predictions(test.where(F.col("model") == best), held.select(KEY, *CHANNELS, CATEGORY)),
        "extremes": EV.extreme_predictions(test),
        "permutation_importance": XP.permutation_importance(found[best], held),
        "learning_curve": learning_curve(train_rows(run, "regression"), ests[best], best, k=run.settings.folds),
        "eco": EV.eco_score(_together(run, "fit", "regression", "run")),
    }
    trees = [t.withColumn("model", F.lit(n)) for n, m in found.items() if (t := XP.feature_importance(m)) is not None]
    if trees:
        out["feature_importance"] = functools.reduce(DataFrame.unionByName, trees)
    return Output(out, facts={"best_reg_model": best})


def _report_classification(run: Run) -> Output:
    preds = run.table("predict classification", "predictions").persist()
    test = preds.where(F.col("split") == "test")
    comparison = EV.model_comparison(test, _together(run, "cross-validate", "classification", "scores"), "classification")
    best = EV.best_model(comparison, "f1", list(run.settings.classifiers)).first()["model"]
    return Output({"comparison": comparison, "confusion_matrix": EV.confusion_matrix(test),
                   "gap": EV.train_test_gap(preds, "classification"),
                   "misclassified": EV.misclassified(test.where(F.col("model") == best))},
                  facts={"best_clf_model": best})


def _explain(run: Run) -> Output:
    """Attributions of the best regression pipeline for all test rows, by trees where it is made of them."""
    best = run.fact("report regression", "best_reg_model")
    model = run.models("regression", [best])[best]
    rows = run.table("split", "regression")
    held = rows.where(F.col("split") == "test")
    shap = (shap_tree(model, held) if hasattr(model.model.stages[-1], "trees")
            else XP.shap_kernel(model, held, rows.where(F.col("split") == "train")))
    ends = run.table("report regression", "extremes").where(F.col("model") == best)  # two rows
    return Output({"shap": shap, "shap_summary": XP.shap_summary(shap),
                   "shap_extremes": shap.join(F.broadcast(ends), KEY)})


def _register(run: Run) -> Output:
    """Registry of all fitted pipelines, and the run's metadata: one row per fact."""
    scored = lambda df, task, score, tuned: df.select(
        F.lit(task).alias("task"), F.regexp_replace("model", " tuned$", "").alias("model"), F.lit(tuned).alias("tuned"),
        F.col(score).alias("score"))
    runs = scored(run.table("report regression", "comparison"), "regression", "r2", False).unionByName(
        scored(run.table("report regression", "tuned_metrics"), "regression", "r2", True)).unionByName(
        scored(run.table("report classification", "comparison"), "classification", "f1", False))
    registry = SC.model_registry(runs)
    facts = {"campaigns": run.committed("prepare")["tables"]["campaigns"]}
    for step in ("prepare", "tune regression", "report regression", "report classification"):
        facts |= run.committed(step)["facts"]
    rows = [(k, json.dumps(v, sort_keys=True)) for k, v in sorted(facts.items())]
    return Output({"registry": registry, "model_info": SC.model_info(registry),
                   "metadata": run.spark.createDataFrame(rows, "key string, value string")}, facts=facts)


TABLE_STEPS: list[Step] = [("load", _load), ("prepare", _prepare), ("explore", _explore), ("split", _split)]


def steps(settings: Settings) -> list[Step]:
    """All steps of a run, in order."""
    out = list(TABLE_STEPS)
    for task, names in (("regression", settings.regressors), ("classification", settings.classifiers)):
        for n in names:
            out.append((f"fit {task} {n}", functools.partial(_fit, task=task, name=n)))
            out.append((f"cross-validate {task} {n}", functools.partial(_cross_validate, task=task, name=n)))
        if task == "regression":
            out.append(("tune regression", _tune))
        out.append((f"predict {task}", functools.partial(_predict, task=task)))
        out.append((f"report {task}", _report_regression if task == "regression" else _report_classification))
    return [*out, ("explain", _explain), ("register", _register)]


def run_batch(spark: SparkSession, root: str, run_id: str, settings: Settings, only: list[Step] | None = None) -> Run:
    """Starts or resumes a run; all its steps are committed afterwards."""
    run = Run(spark, root, run_id, settings)
    run.execute(only if only is not None else steps(settings))
    return run


def manifest_table(run: Run, done: list[Step]) -> DataFrame:
    """``(step, output, rows)`` of every table that the steps wrote."""
    rows = [(n, t, k) for n, _ in done for t, k in sorted(run.committed(n)["tables"].items())]
    return run.spark.createDataFrame(rows, "step string, output string, rows long")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="run or resume the campaign analysis")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--campaigns", help="campaign file or folder, CSV or Parquet by its name")
    source.add_argument("--orders", help="folder of the order tables")
    p.add_argument("--out", required=True, help="folder on shared storage")
    p.add_argument("--run-id", required=True)
    p.add_argument("--fit-on", choices=("all", "train"), default="all")
    p.add_argument("--profile", choices=tuple(TR.PROFILES), default="reference")
    a = p.parse_args(argv)
    kind = "orders" if a.orders else "parquet" if a.campaigns.rstrip("/").endswith("parquet") else "csv"
    spark = SparkSession.builder.appName(f"mixcast {a.run_id}").getOrCreate()
    run = run_batch(spark, a.out, a.run_id, Settings(a.orders or a.campaigns, kind, a.fit_on, a.profile))
    run.table("report regression", "comparison").show(truncate=False)
    run.table("report classification", "comparison").show(truncate=False)


if __name__ == "__main__":
    main()
