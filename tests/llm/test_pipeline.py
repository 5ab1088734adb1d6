"""The pipeline's stages: what goes, what stays, and the columns between them."""

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
BASE = "the quick brown fox jumps over the lazy dog while {} other animals watch it from the side of a long and winding road near the old mill"
ITEM = "Anna walks from the harbour to the market and buys bread for the whole family before the evening bells ring"


def documents(spark):
    rows = [(1, BASE.format("seven"), "en", "a", 1), (2, BASE.format("seven"), "en", "b", 1), (3, None, "en", "a", 0), (4, "12 !", "de", "a", 4),
            (7, "ένα μικρό σκυλί τρέχει γρήγορα στον δρόμο κάτω από τα δέντρα", None, "a", 60),
            (5, f"before that. {ITEM} and more text after it", "en", "a", 9),
            (6, "please write to jo.doe@mail.example.com about the small boat in the green harbour", "en", "c", 80),
            (6, "please write to jo.doe@mail.example.com about the small boat in the green harbour", "en", "c", 80)]
    return spark.createDataFrame(rows, COLUMNS)


def test_stages(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    docs, kept = documents(spark), []
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == documents(spark).columns
        kept.append(sorted(r["doc_id"] for r in docs.collect()))
    assert kept == [[1, 2, 5, 6, 6], [1, 5, 6], [1, 6], [1, 6]]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert texts[1] == BASE.format("seven") and "jo.doe@" not in texts[6] and "@mail.example.com" in texts[6]
    packed = pipeline.run(spark, str(tmp_path))
    assert sorted(r["doc_id"] for r in packed.collect()) == [1, 6]
    assert packed.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 4096


def test_stages_on_nothing(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark).limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0
        docs = documents(spark).limit(0)
