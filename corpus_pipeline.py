"""From documents to packed training sequences, in five stages over the whole corpus.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the
columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm import mixing, packing, secrets, simhash, toxicity
from refinery.llm.common import stage, table, unused
from refinery.llm.queries import tokenizer

#: Documents that score as much are rejected.
REJECT = 0.3
#: Bytes of a batch of rows on its way to Python. Spark's 10,000 texts a batch are 25 MB here, which executors hold several times, in Arrow's buffers and in Python, and do not give back.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "1m")


def small_batches(spark: SparkSession) -> None:
    """Sets BATCH for the session: what a stage returns goes to Python only when it is written."""
    spark.conf.set(*BATCH)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below REJECT; the score is learned from the labels of the given documents."""
    small_batches(spark)
    model, score = toxicity.train(docs, table(spark, sf_dir, "labels")), unused(docs, "toxicity")
    return model.score(docs, score).where(F.col(score) < REJECT).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles of Jaccard similarity 0.8 or more."""
    small_batches(spark)
    return simhash.keep_one_similar(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by [SECRET] and n_chars counted anew."""
    spans, clean = unused(docs, "secrets"), unused(docs, "clean_text")
    found = secrets.scan(docs, into=spans)
    changed = F.size(spans) > 0
    found = found.withColumn(clean, F.when(changed, secrets.redact(F.col("text"), F.col(spans))).otherwise(F.col("text")))
    n_chars = F.when(changed, F.length(clean).cast("long")).otherwise(F.col("n_chars"))
    new = {"text": F.col(clean), "n_chars": n_chars}
    return found.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    small_batches(spark)
    return packing.pack(packing.pieces(docs, tokenizer(), with_ids=False))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The stages learn, hash and tokenise; SQL cannot express them. Tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
