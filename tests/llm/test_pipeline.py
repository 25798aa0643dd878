"""The pipeline's stages, each on its own input, and on odd rows."""
import corpus_pipeline as P
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_stages_keep_the_columns_and_act(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (70001, "", "en", "s", 0), (70002, None, "en", "s", None),
                                 (0, docs.where("doc_id = 0").first().text, "en", "s", 1)], docs.schema)
    d = docs.unionByName(odd)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, d, SF).cache()
        assert out.columns == docs.columns and 0 < out.count() <= d.count(), name
        assert stage(spark, docs.limit(0), SF).count() == 0
        d = out
    assert d.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").count() == 0
    packed = P.STAGES[-1][1](spark, d, SF)
    assert packed.select("doc_id").distinct().count() == d.select("doc_id").distinct().count()


def test_one_of_each_copy_stays(spark):
    text = "a text of several words that is the same in each of its copies"
    rows = [(5, text, "en", "s", 1), (3, text, "en", "s", 1), (3, text, "fr", "t", 1), (9, text + " but not quite", "en", "s", 1),
            (None, text, "en", "s", 1), (None, "quite another text without an id at all", "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = P.first_of_near_duplicates(spark, df, SF)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 3), (False, 9), (True, 0)]
    assert out.where(F.col("doc_id") == 3).count() == 1
