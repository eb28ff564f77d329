"""The change log as a stream: the same graph operators for each batch that arrives (ST1), and new crawl files (ST2)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from refinery.plans import jobs
from refinery.sources.graph_store import GraphStore


def change_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """New files of the log's folder; each is read once."""
    return spark.readStream.schema(schema).parquet(path)


def crawl_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").json(path)


def apply_available(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Runs ``apply(batch, number)`` over what has arrived since the checkpoint, then stops. A batch may be given again after a failure, so ``apply`` must be idempotent."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sync_available(stream: DataFrame, store: GraphStore, metadata: DataFrame, checkpoint: str, source: str = "changes") -> StreamingQuery:
    """ST1: applies to the graph what has arrived in the change log, each batch once, wherever an earlier run was stopped.

    The stream's checkpoint may lag behind the graph's commit by a batch, which is then given again with its
    number and passed over.
    """

    def put(changes: DataFrame, number: int) -> None:
        # Looked at several times: its counts, the nodes and the edges.
        changes = changes.persist()
        try:
            jobs.apply_stream_batch(store, changes, number, source, metadata)
        finally:
            changes.unpersist()

    return apply_available(stream, put, checkpoint)
