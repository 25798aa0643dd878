"""Helpers shared by the training-data operators: tables, checkpoints, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path, ship_package


BATCH = "2000"  # rows of whole texts that a Python worker holds at once


def ready(spark: SparkSession) -> None:
    """Make the package importable on the workers, and their batches of whole texts small unless the session says."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":  # Spark's default
        spark.conf.set(name, BATCH)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of its own in the shared checkpoint folder: columns take less disk than checkpointed rows."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


SMALL = 200_000  # rows of a few numbers each that may be broadcast: some MB


def without(docs: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``docs`` whose ``keys`` (never null) are not in ``gone``.  ``gone`` is broadcast when its counted rows
    are at most ``SMALL``; a larger one is joined by key."""
    gone = cut(gone.select(*keys).distinct())
    return docs.join(F.broadcast(gone) if gone.count() <= SMALL else gone, keys, "left_anti")


class Memo(dict):
    """A dict that fills itself by ``make``; two generations of ``size / 2`` entries bound its memory.

    Memory only: whatever was forgotten is made again.
    """

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.half, self.old = make, size // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(a, b)`` long links -> ``(id, component)`` with the smallest id reachable.

    Alternating large-star / small-star rounds (Kiveris et al., 2014): O(log n) joins, no component or hub is
    ever gathered in one task; minima use partial aggregation and the joins can be split where a hub is hot.
    Ids without a link do not appear.  Nulls and self-links are ignored.
    """
    e = cut(edges.select("a", "b").where("a <> b").distinct())
    last = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        star = (both.join(low, "a").where(F.col("b") > F.col("a"))
                .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = star.groupBy("a").agg(F.min("b").alias("m"))
        moved = star.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cut(moved.union(low.select("a", F.col("m").alias("b"))).distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("connected components did not settle")
    stars = e.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component")
    return stars.union(stars.select(F.col("component").alias("id"), "component").distinct())
