import corpus_pipeline
import pandas as pd
import pytest
from helpers import TEXTS, documents
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", ["toxicity", "simhash_near_dedup", "packing"])
def test_stages_send_texts_to_python_in_small_batches(spark, tmp_path, name):
    """What a stage returns runs with its session's settings, so batches there are bounded by bytes, and nothing is lost by that."""

    def size(batches):
        for b in batches:
            yield pd.DataFrame({"n": [int(b["text"].str.len().sum())]})

    key = corpus_pipeline.BATCH[0]
    before = spark.conf.get(key)
    spark.createDataFrame([(0, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    try:
        spark.conf.unset(key)
        dict(corpus_pipeline.STAGES)[name](spark, documents(spark, TEXTS[:6], extra=False), str(tmp_path))
        wide = spark.range(0, 4000, 1, 1).select(F.concat(F.col("id").cast("string"), F.repeat(F.lit("word "), 400)).alias("text"))
        sizes = [r["n"] for r in wide.mapInPandas(size, "n long").collect()]
    finally:
        spark.conf.set(key, before)
    assert max(sizes) <= 1 << 20
    assert sum(sizes) == sum(len(str(i)) for i in range(4000)) + 4000 * 2000
