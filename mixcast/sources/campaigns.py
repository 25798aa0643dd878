"""Campaign sources: the declared CSV / Parquet input, and campaigns derived from order tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import nan_to_null
from ..schema import CAMPAIGN_CSV_SCHEMA, CHANNELS, KEY

# Order priority -> influencer tier ("4-NOT SPECIFIED" has no tier).
PRIORITY_TO_TIER = {"1-URGENT": "Mega", "2-HIGH": "Macro", "3-MEDIUM": "Micro", "5-LOW": "Nano"}
# Line return flag -> channel whose budget the line funds.
FLAG_TO_CHANNEL = {"A": "TV", "N": "Radio", "R": "Social_Media"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_campaigns(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Scan the campaign file with a declared schema; ``Social Media`` -> ``Social_Media``.

    NaN cells become null.  Campaigns carry no key in the file: the key is a hash of the row's
    content and its number among equal rows, so it does not depend on files or their splits.
    """
    if fmt == "csv":
        df = (spark.read.schema(CAMPAIGN_CSV_SCHEMA).option("header", True)
              .option("mode", "PERMISSIVE").csv(path))
    else:
        df = spark.read.format(fmt).load(path)
    df = df.withColumnRenamed("Social Media", "Social_Media")
    df = df.select(*[nan_to_null(c).alias(c) for c in CHANNELS],
                   F.when(F.trim("Influencer") == "", None).otherwise(F.col("Influencer")).alias("Influencer"),
                   nan_to_null("Sales").alias("Sales"))
    body = [*CHANNELS, "Influencer", "Sales"]
    numbered = number_equal(df, body)
    df = numbered.withColumn(KEY, F.xxhash64(*body, F.col("number").cast("int")))
    return df.select(KEY, *CHANNELS, "Influencer", "Sales")


def number_equal(df: DataFrame, body: list[str]) -> DataFrame:
    """``df`` with ``number``: 1, 2, ... among the rows equal in ``body``, whichever of them is first.

    Rows are numbered inside their input partition; the counts of each content in the partitions before it give
    the offset.  So equal rows meet in one task only as far as they lie in one partition, and a content's counts are
    one row per partition, however often it occurs.
    """
    tagged = df.withColumn("__h", F.xxhash64(*body)).withColumn("__p", F.spark_partition_id())
    here = Window.partitionBy("__p", "__h").orderBy(F.lit(0))
    counts = tagged.groupBy("__p", "__h").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__h").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", "__h", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    local = tagged.withColumn("__i", F.row_number().over(here))
    return local.join(offsets, ["__p", "__h"]).withColumn("number", F.col("__before") + F.col("__i")).drop(
        "__p", "__h", "__i", "__before")


def _fixed(c: str, scale: int):
    """Exact integer of a value with ``scale`` decimals (the unscaled DECIMAL value)."""
    return F.floor(F.col(c) * F.lit(float(10 ** scale)) + F.lit(0.5)).cast("long")


def campaigns_from_orders(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One campaign per order; ``keep`` names columns of the orders to carry along.

    Channel budgets are the order's line values by return flag, sales the discounted,
    taxed line value, both in thousands.  Lines are pre-aggregated per order before the
    join (map-side partial aggregation, so a hot order key never ships its lines), and
    the aggregate is already hash-partitioned by the order key the join needs.

    Money is summed exactly as integers: prices in cents, sales in millionths
    (cents x discount% x tax%).  Integer sums do not depend on row order and stay in the
    fixed-width, code-generated hash aggregate; the result equals a DECIMAL sum
    converted to double (exact integer / 10^k, correctly rounded).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice",
                                                 "l_discount", "l_tax")
    cents = _fixed("l_extendedprice", 2)
    micro = cents * (F.lit(100) - _fixed("l_discount", 2)) * (F.lit(100) + _fixed("l_tax", 2))
    per_order = li.groupBy("l_orderkey").agg(
        *[F.sum(F.when(F.col("l_returnflag") == flag, cents)).alias(f"{ch}_c")
          for flag, ch in FLAG_TO_CHANNEL.items()],
        F.sum(micro).alias("Sales_u"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", *keep)
    tier = F.lit(None).cast("string")
    for prio, name in reversed(list(PRIORITY_TO_TIER.items())):
        tier = F.when(F.col("o_orderpriority") == prio, name).otherwise(tier)
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    thousand = F.lit(1000.0)
    return joined.select(
        F.col("o_orderkey").alias(KEY),
        *[(F.col(f"{ch}_c").cast("double") / F.lit(100.0) / thousand).alias(ch) for ch in CHANNELS],
        tier.alias("Influencer"),
        (F.col("Sales_u").cast("double") / F.lit(1000000.0) / thousand).alias("Sales"), *keep)
