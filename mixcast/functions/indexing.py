"""Dense row index 0..n-1 in a given order, without a window over one partition.

The frame is range-sorted, tagged with partition id and ``monotonically_increasing_id``
and checkpointed (lineage cut, partitions fixed); per-partition counts (one row per
partition) give offsets, which a broadcast join of that small table adds back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def dense_index(df: DataFrame, order: list, name: str = "i") -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    tagged = (df.orderBy(*order).withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n")).collect()
    offsets, acc = [], 0
    for r in sorted(counts, key=lambda r: r["__pid"]):
        offsets.append((r["__pid"], acc))
        acc += r["__n"]
    off = df.sparkSession.createDataFrame(offsets or [(0, 0)], "__pid int, __off long")
    out = tagged.join(F.broadcast(off), "__pid")  # one row per partition
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return out.withColumn(name, F.col("__off") + local).drop("__pid", "__mid", "__off")
