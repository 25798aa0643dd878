"""Session helpers: build a local session for tests, find the shared checkpoint folder."""

from __future__ import annotations

import os
import zipfile

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.scheduler.mode": "FAIR",  # concurrent fits share the cores
}


def local_session(cores: int | str = "*", app: str = "mixcast", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench; clusters pass their own session."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**_LOCAL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session leaves it unset, a folder of the session's default file system (shared on a
    cluster) is used: the path carries no scheme, so Hadoop resolves it there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        path = f"/tmp/mixcast-{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, wherever they were started."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(os.environ.get("TMPDIR", "/tmp"), f"mixcast-{app}-{os.getpid()}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("mixcast", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint root for written intermediate tables."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, name)
