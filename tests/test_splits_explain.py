import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixcast.operators import explain as XP
from mixcast.operators import splits as SP
from mixcast.operators import train as TR
from mixcast.operators.predictors import TrendModel
from mixcast.operators.tuning import learning_curve

RAW = "campaign_id long, TV double, Radio double, Social_Media double, Influencer string, Sales double, Performance string"


def _rows(n=600):
    out = []
    for i in range(n):
        tv, radio, sm = float(i % 97), float((i * 7) % 41), float((i * 3) % 13)
        sales = 3.0 * tv + radio + 0.5 * sm + (i % 5)
        out.append((i, tv, radio, sm, ["Mega", "Macro", "Micro", "Nano"][i % 4], sales, ["Low", "Medium", "High"][i % 3]))
    return out


def test_splits_disjoint_complete_and_stratified(spark):
    df = spark.createDataFrame(_rows(), RAW)
    s = SP.hash_split(df)
    assert s.count() == 600 and set(r["split"] for r in s.select("split").distinct().collect()) == {"train", "test"}
    st = SP.stratified_split(df)
    per = {r["Performance"]: r["n"] for r in st.where("split = 'test'").groupBy("Performance")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per == {"Low": 40, "Medium": 40, "High": 40}
    folds = SP.with_folds(df).select("fold").distinct().collect()
    assert {r["fold"] for r in folds} <= set(range(5))


def test_stratified_folds_are_even_in_every_class(spark):
    rows = _rows(617) + [(1000, 1.0, 1.0, 1.0, "Nano", None, None)] + [(2000 + i, 1.0, 1.0, 1.0, "Nano", 1.0, "Rare") for i in range(3)]
    got = SP.stratified_folds(spark.createDataFrame(rows, RAW).repartition(5))
    sizes = {}
    for r in got.groupBy("Performance", "fold").count().collect():
        sizes.setdefault(r["Performance"], {})[r["fold"]] = r["count"]
    assert sizes.pop(None) == {None: 1}
    assert sum(sizes["Rare"].values()) == 3 and max(sizes["Rare"].values()) == 1
    for c in ("Low", "Medium", "High"):
        assert set(sizes[c]) == set(range(5)) and max(sizes[c].values()) - min(sizes[c].values()) <= 1
    other = SP.stratified_folds(spark.createDataFrame(rows, RAW).coalesce(1))
    both = got.select("campaign_id", "fold").join(other.select("campaign_id", F.col("fold").alias("g")), "campaign_id")
    assert both.where(~F.col("fold").eqNullSafe(F.col("g"))).count() == 0


def test_exact_shapley_equals_closed_form_and_is_additive(spark):
    df = spark.createDataFrame(_rows(200), RAW)
    m = TrendModel.fit(df.withColumn("Total_Budget", F.col("TV") + F.col("Radio") + F.col("Social_Media")),
                       "Total_Budget")
    bg = XP.background_sample(df, size=10)
    ex = XP.shap_exact(m, df.limit(20), bg)
    bgdf = spark.createDataFrame([(b["TV"], b["Radio"], b["Social_Media"]) for b in bg],
                                 "TV double, Radio double, Social_Media double")
    lin = XP.shap_linear(m, df.limit(20), bgdf)
    a = {(r["campaign_id"], r["feature"]): r["shap_value"] for r in ex.collect()}
    b = {(r["campaign_id"], r["feature"]): r["shap_value"] for r in lin.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=2e-6)
    sums = ex.groupBy("campaign_id").agg(F.sum("shap_value").alias("s"), F.first("base_value").alias("b"))
    preds = {r["campaign_id"]: r["prediction"] for r in m.predict(df.limit(20)).collect()}
    for r in sums.collect():
        assert r["s"] + r["b"] == pytest.approx(preds[r["campaign_id"]], abs=1e-4)


def test_permutation_importance_of_unused_column_is_zero(spark):
    df = spark.createDataFrame(_rows(300), RAW)
    m = TrendModel.fit(df.withColumn("Total_Budget", F.col("TV") + F.col("Radio") + F.col("Social_Media")),
                       "Total_Budget")
    out = {r["feature"]: r for r in XP.permutation_importance(m, df, repeats=3).collect()}
    assert out["Influencer"]["importance_mean"] == 0.0 and out["Influencer"]["importance_std"] == 0.0
    assert out["TV"]["importance_mean"] > out["Social_Media"]["importance_mean"] > 0


def test_permuted_columns_keep_their_values(spark, monkeypatch):
    monkeypatch.setattr(XP, "BLOCK", 64)
    df = spark.createDataFrame(_rows(300), RAW).select("campaign_id", *XP.RAW_FEATURES, "Sales")
    base = sorted(map(tuple, df.select(*XP.RAW_FEATURES, "Sales").collect()), key=repr)
    out = XP.permuted(df, ["TV", "Influencer"], 3)
    assert out.count() == 300 * 6
    for r, c in ((0, "TV"), (2, "Influencer")):
        got = out.where((F.col("r") == r) & (F.col("c") == c)).drop("r", "c")
        kept = [x for x in got.columns if x != c]
        assert sorted(map(tuple, got.select(*kept).collect()), key=repr) == sorted(map(tuple, df.select(*kept).collect()), key=repr)
        assert sorted(x[0] for x in got.select(c).collect()) == sorted(x[0] for x in df.select(c).collect())
        assert sorted(map(tuple, got.collect()), key=repr) != base
    one, two = (out.where((F.col("r") == r) & (F.col("c") == "TV")).drop("r", "c") for r in (0, 1))
    assert sorted(map(tuple, one.collect()), key=repr) != sorted(map(tuple, two.collect()), key=repr)


def test_permutation_importance_of_a_fitted_pipeline(spark):
    df = spark.createDataFrame(_rows(300), RAW)
    m, _ = TR.fit_model(df, TR.regression_estimators("quick")["Linear Regression"], "regression")
    out = {r["feature"]: r["importance_mean"] for r in XP.permutation_importance(m, df, repeats=2).collect()}
    assert set(out) == set(XP.RAW_FEATURES) and out["TV"] == max(out.values())


def test_kernel_matrix_equals_enumeration():
    rng = np.random.default_rng(1)
    for m in (1, 2, 3, 6):
        v, w = rng.normal(size=1 << m), XP.shapley_weights(m)
        exact = [sum(w[bin(s).count("1")] * (v[s | 1 << j] - v[s]) for s in range(1 << m) if not s >> j & 1) for j in range(m)]
        assert np.allclose(XP.kernel_matrix(m) @ v, exact, atol=1e-10)


def test_kernel_shap_of_a_fitted_line(spark):
    df = spark.createDataFrame(_rows(200), RAW)
    m, _ = TR.fit_model(df, TR.regression_estimators("quick")["Linear Regression"], "regression")
    sub = df.where("campaign_id < 30")
    got = XP.shap_kernel(m, sub, df, size=10).collect()
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    from mixcast.functions.exprs import hash_hex
    prep = PipelineModel(stages=m.model.stages[:-1])
    enc = lambda d: {r[0]: np.array(r[1]) for r in prep.transform(d).select("campaign_id", vector_to_array("features")).collect()}
    mean = np.mean(list(enc(df.orderBy(hash_hex("campaign_id", 42), "campaign_id").limit(10)).values()), axis=0)
    coef, x = m.model.stages[-1].coefficients.toArray(), enc(sub)
    names = XP.feature_names()
    assert len(got) == 6 * len(x)
    for r in got:  # a line's attribution is coefficient x distance from the background's mean
        j = names.index(r.feature)
        assert r.shap_value == pytest.approx(coef[j] * (x[r.campaign_id][j] - mean[j]), abs=2e-5)


def test_learning_curve_of_a_pipeline(spark):
    df = SP.with_folds(spark.createDataFrame(_rows(400), RAW), 3)
    rows = learning_curve(df, TR.regression_estimators("quick")["Linear Regression"], "line", sizes=3, k=3).collect()
    assert [r.size_idx for r in rows] == [0, 1, 2] and rows[0].n_train < rows[1].n_train < rows[2].n_train
    assert rows[2].n_train == pytest.approx(400 * 2 / 3, abs=1) and all(r.val_mean <= 1 and r.train_std >= 0 for r in rows)


@pytest.mark.parametrize("kind", ["plain", "dependent", "constant"])
def test_least_squares_learning_curve_reads_the_rows_twice(spark, monkeypatch, kind):
    """The scores of the estimator's own fits, without a fit per subset unless the features depend on each other."""
    from mixcast.operators import tuning as TU

    rng = random.Random(5)
    rows = []
    for i in range(600):
        tv = rng.uniform(10, 90)
        radio = {"plain": rng.uniform(0, 9), "dependent": 2 * tv, "constant": 7.5}[kind]
        sm = 1e6 + rng.uniform(0, 5)  # far from 0
        rows.append((i, tv, radio, sm, rng.choice(["Mega", "Macro", "Nano"]), 3 * tv + radio + sm / 10 + rng.gauss(0, 9), i % 3))
    df = spark.createDataFrame(rows, "campaign_id long, TV double, Radio double, Social_Media double, Influencer string, "
                                     "Sales double, fold int").persist()
    est = TR.regression_estimators("quick")["Linear Regression"]
    fits, fit_model = [], TR.fit_model
    monkeypatch.setattr(TR, "fit_model", lambda *a, **kw: fits.append(1) or fit_model(*a, **kw))
    got = learning_curve(df, est, "line", sizes=2, k=3).orderBy("size_idx").collect()
    assert len(fits) == (6 if kind == "dependent" else 0)
    monkeypatch.setattr(TU, "_least_squares", lambda *a: False)
    want = learning_curve(df, est, "line", sizes=2, k=3).orderBy("size_idx").collect()
    for g, w in zip(got, want, strict=True):
        assert tuple(g)[:4] == tuple(w)[:4] and list(g)[4:] == pytest.approx(list(w)[4:], abs=3e-6)
    df.unpersist()
