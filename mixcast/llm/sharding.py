"""Operator 8: contiguous byte-balanced shards from global prefix sums of per-partition totals.

Rows are ranged by (hash of the text, id), so equal texts stand together.  Each range partition's total of bytes and
rows gives its offset (one row per partition); a running sum inside the partition completes the global prefix sum,
and the corpus is cut at equal byte targets.  A cut that would split a run of equal texts moves to the run's nearer
end when the run is at most ``1/SNAP`` of a shard, so only groups too large to keep whole are split.  DataFrame
functions only; no text is shuffled.

Defined results: a null text has size 1 and checksum 0 (as the empty text has); null ids are ranged first; repeated
rows are rows like any other; an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SNAP = 50


def assign(docs: DataFrame, id_col: str, text: str = "text", shards: int = 16) -> DataFrame:
    """``(id, size, text_crc32, shard, slot)``: shards 0..shards-1, contiguous in the order, sizes near equal."""
    t = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"),
                       (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
                       F.coalesce(F.crc32(t.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
                       F.xxhash64(t).alias("grp"))
    rows = cut(rows.repartitionByRange("grp", "id").sortWithinPartitions("grp", "id")
               .select("*", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("mid")))
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("pid").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    offsets = totals.select("pid", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))  # one row per partition
    inside = Window.partitionBy("pid").orderBy("mid").rowsBetween(Window.unboundedPreceding, 0)
    placed = cut(rows.join(F.broadcast(offsets), "pid").select(
        "id", "size", "text_crc32", "grp",
        (F.col("b0") + F.sum("size").over(inside) - F.col("size")).alias("start"),
        (F.col("n0") + F.row_number().over(inside) - 1).alias("row")))
    cuts = _cuts(placed, shards)
    shard = sum([F.when(F.col("start") >= c, 1).otherwise(0) for c in cuts], F.lit(0)).cast("int")
    placed = placed.withColumn("shard", shard)
    firsts = placed.groupBy("shard").agg(F.min("row").alias("row0"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "id", "size", "text_crc32", "shard", (F.col("row") - F.col("row0")).cast("long").alias("slot"))


def _cuts(placed: DataFrame, shards: int) -> list[int]:
    """The ``shards - 1`` byte positions where a shard begins; only that many values reach the driver."""
    total = placed.agg(F.sum("size")).first()[0] or 0
    cuts = [-(-k * total // shards) for k in range(1, shards)]
    at = sum([F.when((F.col("start") < c) & (F.col("start") + F.col("size") >= c), 1).otherwise(0) for c in cuts], F.lit(0))
    hit = [r[0] for r in placed.where(at > 0).select("grp").distinct().collect()]  # at most one group per cut
    runs = placed.where(F.col("grp").isin(hit)).groupBy("grp").agg(
        F.min("start").alias("a"), F.max(F.col("start") + F.col("size")).alias("b")).collect() if hit else []
    out = []
    for c in cuts:
        ends = [e for r in runs if r["a"] < c < r["b"] and (r["b"] - r["a"]) * SNAP * shards <= total for e in (r["a"], r["b"])]
        out.append(min(ends, key=lambda e: (abs(e - c), e)) if ends else c)
    return out


def write_shards(docs: DataFrame, assigned: DataFrame, id_col: str, path: str) -> None:
    """Write whole rows to ``path/shard=N/`` in slot order; ids must be unique and not null."""
    keyed = assigned.select(F.col("id").alias("__id"), "shard", "slot")
    (docs.join(keyed, docs[id_col] == keyed["__id"]).drop("__id")
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("errorifexists").partitionBy("shard").parquet(path))
