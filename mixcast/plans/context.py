"""Per-(session, data folder) context: the campaign tables every named query starts from.

The enriched table is built once and persisted (MEMORY_AND_DISK: a lost executor's
blocks are recomputed from lineage), so the catalogue's queries share one scan of the
order tables instead of one each.
"""

from __future__ import annotations

import threading

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import rnd

from ..operators.prepare import PrepStats, prepare
from ..sources.campaigns import campaigns_from_orders

_LOCK = threading.Lock()
_CACHE: dict = {}


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw: DataFrame | None = None
        self._camp: DataFrame | None = None
        self.stats: PrepStats | None = None
        self.memo: dict = {}

    @property
    def ordered(self) -> DataFrame:
        """The raw campaigns with the customer of their order: one join of the order tables for both."""
        if self._raw is None:
            self._raw = campaigns_from_orders(self.spark, self.sf_dir, ("o_custkey",)).persist(StorageLevel.MEMORY_AND_DISK)
        return self._raw

    @property
    def raw(self) -> DataFrame:
        return self.ordered.drop("o_custkey")

    @property
    def camp(self) -> DataFrame:
        if self._camp is None:
            camp, self.stats = prepare(self.raw, reuse="none")
            self._camp = camp.persist(StorageLevel.MEMORY_AND_DISK)
        return self._camp

    def get(self, name: str, build):
        """Memoise a derived object (split table, fitted model) for the session."""
        if name not in self.memo:
            self.memo[name] = build()
        return self.memo[name]


def context(spark: SparkSession, sf_dir: str) -> Context:
    key = (id(spark), str(spark.sparkContext.applicationId), sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _CACHE:
            _CACHE[key] = Context(spark, sf_dir.rstrip("/"))
        return _CACHE[key]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (report precision shared with the SQL oracle)."""
    return df.select(*[rnd(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
