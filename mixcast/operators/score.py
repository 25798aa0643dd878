"""Scenario scoring and the model registry.

Scenarios are rows (or JSON requests) of budgets, a tier and a model name.  They are
validated into accepted and rejected tables with reason codes, then scored in one pass
per model: a narrow projection per model, unioned, so a batch of any size is one job.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import rnd
from ..schema import CATEGORIES, CATEGORY, CHANNELS, DEPLOYMENT_COMPLEXITY, SCENARIO_SCHEMA, TARGET_CLF, TARGET_REG

REASONS = ["invalid_json", "missing_field", "negative_budget", "unknown_influencer", "model_not_found"]
FAILED = "prediction_failed"
TARGETS = {"regression": TARGET_REG, "classification": TARGET_CLF}


def parse_scenarios(requests: DataFrame, body: str = "body", rid: str = "request_id") -> DataFrame:
    """S3: JSON bodies -> typed scenario columns; a malformed body gives ``parsed = false``."""
    st = F.from_json(F.col(body), SCENARIO_SCHEMA, {"mode": "PERMISSIVE"})
    ok = F.expr(f"try_parse_json({body})").isNotNull() & F.col(body).rlike(r"^\s*\{")
    out = requests.select(rid, ok.alias("parsed"), st.alias("s"))
    return out.select(rid, "parsed", *[F.when(F.col("parsed"), F.col(f"s.{c}")).alias(c)
                                       for c in ["TV", "Radio", "Social_Media", "Influencer", "model"]])


def validate_scenarios(scen: DataFrame, registry_models: list[str] | None = None, default_model: str | None = None,
                       rid: str = "request_id") -> DataFrame:
    """First failing rule as ``reason`` (null when accepted); missing model -> default.

    Rules, in order: body not JSON, a field missing, a negative budget, a tier outside the
    closed list, then (when a registry is given) a model name it does not hold.
    """
    parsed = F.col("parsed") if "parsed" in scen.columns else F.lit(True)
    model = F.coalesce(F.col("model"), F.lit(default_model)) if default_model else F.col("model")
    missing = F.lit(False)
    for c in [*CHANNELS, "Influencer"]:
        missing = missing | F.col(c).isNull()
    negative = F.lit(False)
    for c in CHANNELS:
        negative = negative | (F.col(c) < 0)
    reason = (F.when(~parsed, REASONS[0]).when(missing, REASONS[1]).when(negative, REASONS[2])
              .when(~F.col("Influencer").isin(*CATEGORIES), REASONS[3]))
    if registry_models is not None:
        reason = reason.when(model.isNull() | ~model.isin(*registry_models), REASONS[4])
    return scen.select(rid, *CHANNELS, "Influencer", model.alias("model"), reason.alias("reason"))


def scenario_status(validated: DataFrame, rid: str = "request_id") -> DataFrame:
    return validated.select(rid, F.when(F.col("reason").isNull(), "accepted").otherwise("rejected").alias("status"),
                            "reason")


def _predicted(accepted: DataFrame, models: dict, rid: str) -> DataFrame:
    """``__p`` and ``__why`` of every accepted scenario: each model scores only its own (filter + projection).

    A prediction that is missing or not finite says so; a model that cannot be applied at all fails its own scenarios
    only, with its error as the reason.
    """
    parts = []
    for name, m in models.items():
        mine = accepted.where(F.col("model") == F.lit(name))
        try:
            p, why = m.predict(mine).select(rid, "model", *CHANNELS, F.col("prediction").cast("double").alias("__p")), ""
        except Exception as error:  # noqa: BLE001  (whatever a model raises while its plan is built)
            p = mine.select(rid, "model", *CHANNELS, F.lit(None).cast("double").alias("__p"))
            why = f": {type(error).__name__}"
        bad = F.col("__p").isNull() | F.isnan("__p") | (F.abs("__p") == float("inf"))
        parts.append(p.withColumn("__why", F.when(bad, FAILED + why)))
    return functools.reduce(DataFrame.unionByName, parts)


def score_quarantined(accepted: DataFrame, models: dict, rid: str = "request_id", with_timestamp: bool = True
                      ) -> tuple[DataFrame, DataFrame]:
    """``(scored, rejected)``: scenarios whose prediction fails are set aside with a reason, the rest is scored."""
    out = _predicted(accepted, models, rid)
    return (_report(out.where(F.col("__why").isNull()), rid, with_timestamp),
            out.where(F.col("__why").isNotNull()).select(rid, "model", F.col("__why").alias("reason")))


def score_scenarios(accepted: DataFrame, models: dict, rid: str = "request_id",
                    with_timestamp: bool = True) -> DataFrame:
    """Predicted sales, total budget, ROI (0.0 for a zero budget, unlike P6), profit, round 4."""
    return score_quarantined(accepted, models, rid, with_timestamp)[0]


def _report(out: DataFrame, rid: str, with_timestamp: bool) -> DataFrame:
    total = F.col("TV") + F.col("Radio") + F.col("Social_Media")
    roi = F.when(total > 0, F.col("__p") / total).otherwise(F.lit(0.0))
    cols = [rid, F.col("model").alias("model_used"), rnd("__p", 4).alias("predicted_sales_M"),
            rnd(roi, 4).alias("roi_estimate"), rnd(total, 4).alias("total_budget_M"),
            rnd(F.col("__p") - total, 4).alias("profit_estimate_M"), rnd(roi - F.lit(1.0), 4).alias("roi_vs_threshold"),
            (F.col("__p") - total > 0).alias("profitable")]
    if with_timestamp:
        cols.append(F.current_timestamp().alias("timestamp"))
    return out.select(*cols)


def score_all_models(accepted: DataFrame, models: dict, rid: str = "request_id", digits: int = 2) -> DataFrame:
    """Every scenario under every model (one projection per model, unioned)."""
    parts = [m.predict(accepted).select(rid, F.lit(name).alias("model"), rnd("prediction", digits).alias("predicted_sales"))
             for name, m in models.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sensitivity(scenarios: DataFrame, model, max_budget: dict, points: int = 60, keys=("Influencer",)) -> DataFrame:
    """Vary one channel over ``points`` values 0..max, others fixed, for each scenario.

    The (channel, point) grid is generated per row with ``explode(sequence)`` - a
    generator, no join - and scored by one ``predict`` over the expanded rows.
    """
    grid = F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.lit(float(max_budget[c])).alias("mx"))
                               for c in CHANNELS])).alias("g")
    x = scenarios.select("*", grid).select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    value = F.col("g.mx") / F.lit(points - 1) * F.col("i")
    for c in CHANNELS:
        x = x.withColumn(c, F.when(F.col("g.channel") == c, value).otherwise(F.col(c)))
    scored = model.predict(x)
    return scored.select(*keys, F.col("g.channel").alias("channel"), "i", rnd(value, 6).alias("budget"),
                         rnd("prediction", 4).alias("predicted_sales"))


# ---------------------------------------------------------------- registry

def model_registry(runs: DataFrame) -> DataFrame:
    """One row per (task, model, tuned) with availability and the best model per task."""
    w = Window.partitionBy("task")  # a registry holds a handful of models per task
    return runs.select("task", "model", "tuned", "score").withColumn(
        "is_best", F.col("score") == F.max("score").over(w))


def resolve_models(registry: DataFrame) -> DataFrame:
    """A tuned model replaces the base one of the same name (one row per task and name)."""
    w = Window.partitionBy("task", "model").orderBy(F.desc("tuned"))
    return registry.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def default_model(registry: DataFrame, task: str, order: list[str]) -> DataFrame:
    """The best model of the task, else the first available in ``order``."""
    pos = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return (registry.where(F.col("task") == task)
            .orderBy(F.desc("is_best"), F.desc("score"), pos).limit(1).select("task", "model"))


def model_info(registry: DataFrame, targets: dict[str, str] | None = None) -> DataFrame:
    """Per task the available models (sorted, comma-joined), the best one, their count, the service status
    (``degraded`` without a model), the target and the input features."""
    best = F.min_by(F.col("model"), F.struct((-F.col("score")).alias("s"), F.col("model").alias("m")))
    found = registry.groupBy("task").agg(
        F.array_join(F.array_sort(F.collect_set("model")), ", ").alias("available_models"),
        best.alias("best_model"), F.countDistinct("model").alias("n"))
    tasks = registry.sparkSession.createDataFrame(list((targets or TARGETS).items()), "task string, target string")
    n = F.coalesce("n", F.lit(0).cast("long"))
    return tasks.join(found, "task", "left").select(  # one row per task
        "task", F.coalesce("available_models", F.lit("")).alias("available_models"), "best_model", n.alias("n_models"),
        F.when(n > 0, "healthy").otherwise("degraded").alias("status"), "target",
        F.lit(", ".join([*CHANNELS, CATEGORY])).alias("input_features"))


def label_features(df: DataFrame, col: str = "feature") -> DataFrame:
    """Readable labels: a fixed map for the channels, else 'Influencer_X' -> 'Influencer X'."""
    from ..schema import FEATURE_LABELS
    m = F.create_map(*[F.lit(x) for kv in FEATURE_LABELS.items() for x in kv])
    return df.withColumn("label", F.coalesce(F.element_at(m, F.col(col)),
                                             F.regexp_replace(F.col(col), "^Influencer_", "Influencer ")))


def deployment_cost(runs: DataFrame) -> DataFrame:
    """Left lookup of each model in the static deployment table; '?' when absent."""
    dim = runs.sparkSession.createDataFrame(DEPLOYMENT_COMPLEXITY, "model string, params_est string, "
                                            "inference_ms string, export string, note string")
    j = runs.select("task", "model").distinct().join(F.broadcast(dim), "model", "left")  # fixed 5-row table
    return j.select("task", "model", *[F.coalesce(c, F.lit("?")).alias(c) for c in
                                       ["params_est", "inference_ms", "export", "note"]])


def merge_metadata(left: DataFrame, right: DataFrame, key: str = "key") -> DataFrame:
    """Merge two key/value tables, the right one wins on shared keys."""
    return left.alias("l").join(right.alias("r"), key, "full").select(
        key, F.coalesce(F.col("r.value"), F.col("l.value")).alias("value"))
