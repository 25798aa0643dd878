"""Writing reports, models, attributions and run metadata; loading models back.

Everything goes to a folder the caller names (on a cluster: shared storage).  Reports
and attributions are Parquet (or CSV for small reports); run metadata is appended to a
table partitioned by ``run_id`` so a run's rows can be pruned by partition.
"""

from __future__ import annotations

import json
import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def safe_name(name: str) -> str:
    """File-name form of a model name (spaces to underscores, parentheses dropped)."""
    return name.replace(" ", "_").replace("(", "").replace(")", "")


def write_report(df: DataFrame, root: str, name: str, fmt: str = "parquet") -> str:
    """Overwrite one report table; CSV gets a header."""
    path = os.path.join(root, name)
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def save_models(models: dict, task: str, root: str) -> dict[str, str]:
    """Save every fitted pipeline under ``<task>_<name>``; returns name -> path."""
    out = {}
    for name, m in models.items():
        path = os.path.join(root, f"{task}_{safe_name(name)}")
        m.model.write().overwrite().save(path)
        out[name] = path
    return out


def _located(spark: SparkSession, path: str):
    """A path and its own Hadoop file system."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(sc._jsc.hadoopConfiguration())


def _exists(path: str) -> bool:
    at, fs = _located(SparkSession.getActiveSession(), path)
    return fs.exists(at)


def content_summary(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files and bytes below a path."""
    at, fs = _located(spark, path)
    found = fs.getContentSummary(at)
    return found.getFileCount(), found.getLength()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small text file, replaced if it exists; on object stores it appears whole."""
    at, fs = _located(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None where there is none."""
    at, fs = _located(spark, path)
    if not fs.exists(at):
        return None
    source = fs.open(at)
    try:
        return bytes(source.readAllBytes()).decode("utf-8", "replace")
    finally:
        source.close()


def load_models(task: str, names: list[str], root: str) -> dict:
    """Load the saved pipelines that exist; missing ones are skipped."""
    from ..operators.predictors import SparkModel
    from ..schema import CLASSES

    out = {}
    for name in names:
        path = os.path.join(root, f"{task}_{safe_name(name)}")
        if _exists(path):
            out[name] = SparkModel(PipelineModel.load(path), task, CLASSES if task == "classification" else None)
    return out


def write_attributions(shap: DataFrame, root: str, model: str) -> str:
    """Shapley values as a long Parquet table partitioned by model; only that model's part is replaced."""
    path = os.path.join(root, "attributions")
    shap.withColumn("model", F.lit(model)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("model").parquet(path)
    return path


def write_run(spark: SparkSession, root: str, run_id: str, meta: dict) -> str:
    """Append one run's metadata (key, value as JSON text) partitioned by ``run_id``."""
    rows = [(k, json.dumps(v, default=str)) for k, v in sorted(meta.items())]
    df = spark.createDataFrame(rows, "key string, value string").withColumn("run_id", F.lit(run_id))
    path = os.path.join(root, "runs")
    df.write.mode("append").partitionBy("run_id").parquet(path)
    return path


def read_run(spark: SparkSession, root: str, run_id: str) -> dict:
    rows = spark.read.parquet(os.path.join(root, "runs")).where(F.col("run_id") == run_id).collect()
    return {r["key"]: json.loads(r["value"]) for r in rows}
