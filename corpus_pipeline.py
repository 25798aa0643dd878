"""The corpus pipeline: toxicity, language ID, SimHash near-dedup, substring dedup, best-fit packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)``, works on all rows of ``docs`` and
returns a DataFrame: the columns of ``documents`` for all but the last stage.  ``run`` applies them to ``documents``,
each stage written to the shared checkpoint folder before the next reads it.  No stage can be expressed in SQL, so
``ORACLE_SQL`` is None; ``tests/llm`` holds the stages against brute force.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from mixcast.llm import language_id, queries, simhash, substring, toxicity  # noqa: E402
from mixcast.llm.common import cut, ready, table, without  # noqa: E402


def _keyed(docs: DataFrame, **more) -> DataFrame:
    """``docs`` with key columns that are never null: the id, whether it is null, and a hash of the text."""
    return docs.select("*", F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("doc_id").isNull().alias("__none"),
                       F.xxhash64("text").alias("__hash"), *[c.alias(k) for k, c in more.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score (learnt from ``labels``) does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, name="__toxicity").where(F.col("__toxicity") < 0.5).select(*docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language could be told, and those with letters that declare one too rare for a model; their other
    columns, ``lang`` too, stay as they are."""
    ready(spark)
    # a decision depends on the text, the declared language and the source only
    keyed = _keyed(docs, __rest=F.xxhash64("lang", "source"))
    keys = ["__id", "__none", "__hash", "__rest"]
    found = language_id.identify(language_id.document_rows(keyed), keys, unknown="__alien")
    return without(keyed, found.where(~F.col("accepted") & ~F.col("__alien")), keys).select(*docs.columns)


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest id (null last), then the smallest hash of the text."""
    ready(spark)
    comp = cut(simhash.near_duplicates(docs, "doc_id", "text", shingle=3, max_bits=2).select(
        "cluster", F.coalesce("id", F.lit(0)).alias("__id"), F.col("id").isNull().alias("__none"), F.col("th").alias("__hash")))
    keys = ["__none", "__id", "__hash"]
    first = comp.groupBy("cluster").agg(F.min(F.struct(*keys)).alias("m")).select("cluster", "m.*")
    first = first.select(F.col("cluster").alias("c"), *[F.col(k).alias(f"{k}_") for k in keys])
    later = comp.join(first, comp["cluster"] == first["c"]).where(
        F.struct(*keys) != F.struct(*[F.col(f"{k}_") for k in keys]))
    kept = without(_keyed(docs), later, keys)
    if comp.groupBy(*keys).count().where("count > 1").limit(1).count():  # rows repeated in id and text: one stays
        kept = kept.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))).where("__n = 1")
    return kept.select(*docs.columns)


def without_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without sentences that a repeated span covers; ``n_chars`` follows the text."""
    ready(spark)
    out = substring.deduplicate(docs, "doc_id")
    size = F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))
    return out.withColumn("n_chars", size.cast(dict(docs.dtypes)["n_chars"])).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    ready(spark)
    return queries.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", known_language),
    ("simhash_dedup", first_of_near_duplicates),
    ("substring_dedup", without_repeated_spans),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
