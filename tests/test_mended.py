"""Faults once found, each by the case that showed it."""
import math

import duckdb
from pyspark.sql import functions as F

from mixcast.functions.exprs import rnd
from mixcast.functions.quantiles import quantiles
from mixcast.operators.predictors import TercileClassifier, TrendModel
from mixcast.plans import catalog
from mixcast.plans.oracle import expand_round
from mixcast.sources.campaigns import number_equal, read_campaigns
from mixcast.sources.sinks import _exists, write_attributions


def test_rewritten_path_gives_new_quantiles(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    for shift, want in ((0, 49.5), (1000, 1049.5)):
        spark.range(100).select((F.col("id") + shift).cast("double").alias("x")).write.mode("overwrite").parquet(path)
        assert quantiles(spark.read.parquet(path), ["x"], [0.5])[((), "x", 0.5)] == want


def test_second_model_keeps_the_first(spark, tmp_path):
    for name in ("A", "B"):
        path = write_attributions(spark.createDataFrame([(1, 0.5)], "row long, value double"), str(tmp_path), name)
    assert {r["model"] for r in spark.read.parquet(path).collect()} == {"A", "B"}


def test_models_are_found_by_uri(spark, tmp_path):
    assert _exists(f"file://{tmp_path}") and not _exists(f"file://{tmp_path}/none")


def test_key_does_not_depend_on_files(spark, tmp_path):
    rows = [(float(i % 7), 1.0, 2.0, "Macro", float(i)) for i in range(200)] * 2
    df = spark.createDataFrame(rows, "TV double, Radio double, Social_Media double, Influencer string, Sales double")
    keys = []
    for n in (1, 5):
        path = str(tmp_path / f"p{n}")
        df.repartition(n).write.parquet(path)
        keys.append({r[0] for r in read_campaigns(spark, path, "parquet").select("campaign_id").collect()})
    assert keys[0] == keys[1] and len(keys[0]) == 400


def test_ties_at_a_half_go_to_the_even_digit(spark):
    values = [0.5, 1.5, 2.5, -0.5, -1.5, 0.3, -0.3, 1e17]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", rnd("x", 0).alias("r")).collect()
    assert [r["r"] for r in rows] == [float(round(v)) for v in values]
    assert all(math.copysign(1, r["r"]) > 0 for r in rows if r["r"] == 0)
    assert spark.range(1).select(rnd(F.lit(0.125), 2)).first()[0] == 0.12
    con = duckdb.connect()
    assert con.execute(expand_round("SELECT " + ", ".join(f"round(CAST({v!r} AS DOUBLE), 0)" for v in values))).fetchone() == \
        tuple(r["r"] for r in rows)


def test_equal_rows_are_numbered_over_partitions(spark):
    rows = [(1.0, "a")] * 3000 + [(None, None)] * 500 + [(float(i % 50), "b") for i in range(2000)]
    df = spark.createDataFrame(rows, "x double, y string").repartition(7)
    got = number_equal(df, ["x", "y"]).groupBy("x", "y").agg(F.count("number").alias("n"), F.countDistinct("number").alias("d"),
                                                           F.min("number").alias("lo"), F.max("number").alias("hi"))
    found = {(r.x, r.y): (r.n, r.d, r.lo, r.hi) for r in got.collect()}
    assert found[1.0, "a"] == (3000, 3000, 1, 3000) and found[None, None] == (500, 500, 1, 500)
    assert all(v == (40, 40, 1, 40) for (x, y), v in found.items() if y == "b")


def test_gap_report_tells_every_classifier(spark, monkeypatch):
    rows = [(i, float(i), ("Low", "Medium", "High")[i % 3], "test" if i % 4 == 0 else "train") for i in range(48)]
    table = spark.createDataFrame(rows, "campaign_id long, TV double, Performance string, split string")
    model = TercileClassifier(TrendModel("TV", 0.0, 1.0), 16.0, 32.0)
    monkeypatch.setattr(catalog, "_fitted", lambda spark, sf, task, names: ({n: model for n in names}, None))
    monkeypatch.setattr(catalog, "clf_table", lambda spark, sf: table)
    assert sorted(r["model"] for r in catalog.q_ml_gap_clf(spark, "none").collect()) == sorted(catalog.CLASSIFIERS)
