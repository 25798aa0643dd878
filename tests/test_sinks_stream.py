import os

from pyspark.sql import functions as F

from mixcast.operators import train as TR
from mixcast.operators.predictors import TrendModel
from mixcast.sources import sinks
from mixcast.streaming.score_stream import read_rejected, read_scored, stream_score

RAW = "campaign_id long, TV double, Radio double, Social_Media double, Influencer string, Sales double, Performance string"


def _rows(n=300):
    return [(i, float(i % 97), float((i * 7) % 41), float((i * 3) % 13), ["Mega", "Macro", "Micro", "Nano"][i % 4],
             3.0 * (i % 97) + (i * 7) % 41 + (i % 5), ["Low", "Medium", "High"][i % 3]) for i in range(n)]


def test_model_and_run_round_trip(spark, tmp_path):
    df = spark.createDataFrame(_rows(), RAW)
    m, _ = TR.fit_model(df, TR.regression_estimators("quick")["Linear Regression"], "regression")
    sinks.save_models({"Linear Regression": m}, "regression", str(tmp_path))
    back = sinks.load_models("regression", ["Linear Regression", "Random Forest"], str(tmp_path))
    assert list(back) == ["Linear Regression"]  # missing models are skipped
    a = {r["campaign_id"]: r["prediction"] for r in m.predict(df).collect()}
    b = {r["campaign_id"]: r["prediction"] for r in back["Linear Regression"].predict(df).collect()}
    assert a == b
    sinks.write_run(spark, str(tmp_path), "r1", {"best_reg_model": "Linear Regression", "n_train": 300})
    sinks.write_run(spark, str(tmp_path), "r2", {"best_reg_model": "Other"})
    assert sinks.read_run(spark, str(tmp_path), "r1") == {"best_reg_model": "Linear Regression", "n_train": 300}
    p = sinks.write_report(df.groupBy("Influencer").count(), str(tmp_path), "counts", fmt="csv")
    assert spark.read.option("header", True).csv(p).count() == 4


def test_stream_equals_batch(spark, tmp_path):
    bodies = [(i, f'{{"TV": {i}.5, "Radio": 2, "Social_Media": 1, "Influencer": "Nano"}}') for i in range(40)]
    bodies.append((99, "not json"))
    src = os.path.join(str(tmp_path), "in")
    spark.createDataFrame(bodies, "request_id long, body string").repartition(3).write.parquet(src)
    model = TrendModel("Total_Budget", 1.0, 2.0)
    q = stream_score(spark, src, {"T": model}, "T", os.path.join(str(tmp_path), "out"),
                     os.path.join(str(tmp_path), "ck"), with_timestamp=False)
    q.awaitTermination()
    scored = read_scored(spark, os.path.join(str(tmp_path), "out"))
    assert scored.count() == 40
    r = scored.where("request_id = 3").first()
    assert r["predicted_sales_M"] == 1.0 + 2.0 * 6.5 and r["model_used"] == "T"
    rej = read_rejected(spark, os.path.join(str(tmp_path), "out")).collect()
    assert [(x["request_id"], x["reason"]) for x in rej] == [(99, "invalid_json")]
