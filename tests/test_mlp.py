"""The neural regressor packs its rows once; epochs do not read the campaigns again."""
import random

from pyspark.sql import functions as F

from mixcast.operators.mlp import fit_mlp_regressor


def test_epochs_read_packed_rows(spark):
    n, rng = 600, random.Random(2)
    seen = spark.sparkContext.accumulator(0)
    rows = []
    for i in range(n):
        tv = rng.random() * 10
        rows.append((i, tv, rng.random(), rng.random(), "Nano", 3.0 * tv))

    def count(row):
        seen.add(1)
        return row

    train = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3).map(count),
                                  "campaign_id long, TV double, Radio double, Social_Media double, Influencer string, Sales double")
    model, _, history = fit_mlp_regressor(train, hidden=(8,), lr=0.02, batch=50, max_epochs=12, patience=12)
    assert len(history) == 12 and history[-1] < history[0] / 2
    assert seen.value <= 2 * n  # the scaling and the packing
    held = model.predict(train).agg(F.avg(F.abs(F.col("prediction") - F.col("Sales")))).first()[0]
    assert held < 5
