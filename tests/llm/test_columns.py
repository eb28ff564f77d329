"""Stages keep the caller's columns, whatever their names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from refinery.llm import mixing, secrets, simhash
from refinery.llm.common import stage

SF = "/root/testdata/sf0.001"
NAMES = ["_key", "_n", "_d", "_k", "_id", "_text", "_hash", "class", "band", "_kinds", "_copy", "_toxicity", "_row", "_k0", "_times", "row", "size", "fp", "node", "key", "_class", "_secrets", "component", "n", "taken", "toxicity", "secrets", "clean_text", "score"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    copies = rows.where("doc_id < 10").unionByName(rows.where("doc_id < 3")).unionByName(rows.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    return stage(rows.unionByName(copies))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_keeps_clashing_columns(spark, docs, name):
    f = dict(corpus_pipeline.STAGES)[name]
    plain = f(spark, docs, SF)
    wide = stage(docs.withColumns({n: F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for n in NAMES}))
    out = f(spark, wide, SF)
    assert out.columns == wide.columns
    got = out.collect()
    assert all(r[n] == f"{n}:{'none' if r['doc_id'] is None else r['doc_id']}" for r in got for n in NAMES)
    key = lambda r: (str(r["doc_id"]), r["text"], r["source"])
    assert sorted(map(str, map(key, got))) == sorted(map(str, map(key, plain.collect())))


def test_ties_are_told_by_other_columns(spark):
    """Of rows that agree in doc_id and text, the same one stays in every run, however the rows are dealt."""
    df = spark.createDataFrame([(1, "the same text of several words here", "s", f"mark {n}") for n in range(20)], "doc_id long, text string, source string, mark string")
    for f in (simhash.keep_one_similar, simhash.keep_one, lambda d: mixing.apply_mix(d, cap=0.4)):
        runs = [sorted(r["mark"] for r in f(stage(df.repartition(n))).collect()) for n in (1, 4, 7)]
        assert runs[0] == runs[1] == runs[2] and runs[0]


@pytest.mark.parametrize("text, n", [("0123456789abcdef" * 2 + " ", 30_000), ("token=abcdefgh1 ", 60_000)])
def test_many_secrets_in_one_text(spark, text, n):
    """Linear in the number of matches; places and the redacted text are right to the end."""
    df = spark.createDataFrame([(1, "é" + text * n)], "doc_id long, text string")
    found = secrets.scan(df).withColumn("redacted", secrets.redact(F.col("text"), F.col("secrets")))
    r = stage(found).first()
    size, rest = len(text) - 1, text[len(text) - 1 :]
    assert len(r["secrets"]) == n and (r["secrets"][-1]["start"], r["secrets"][-1]["end"]) == (1 + len(text) * (n - 1), 1 + len(text) * (n - 1) + size)
    assert r["redacted"] == "é" + ("[SECRET]" + rest) * n
