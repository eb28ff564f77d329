"""The graph as snapshots: nodes, edges and the checkpoint change in one commit."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.schemas import CHECKPOINT
from refinery.sources.snapshots import Snapshot, SnapshotLog


class GraphStore:
    """Nodes (key and properties) and edges (key, target) below one folder, with the log of what was applied (G3, G8, ST1).

    A snapshot holds both tables whole. Its commit also names the changes it comes from: the time of the newest
    batch (the mark), their counts, and the number of the stream's batch. So after a failure at any point
    either all of it is there or nothing, and what was applied is not applied again.
    """

    def __init__(self, spark: SparkSession, path: str, nodes: T.StructType, edges: T.StructType) -> None:
        self.spark, self.path, self.schemas = spark, path, {"nodes": nodes, "edges": edges}
        self.log = SnapshotLog(spark, path)

    def read(self, snapshot_id: str | None = None) -> tuple[DataFrame, DataFrame]:
        """(nodes, edges) of a snapshot, the newest without an id; empty tables before the first."""
        found = [s for s in self.log.snapshots() if snapshot_id in (None, s.snapshot_id)]
        if not found and snapshot_id:
            raise ValueError(f"no snapshot {snapshot_id} in {self.path}; it may have expired")
        if not found:
            return tuple(self.spark.createDataFrame([], s) for s in self.schemas.values())
        return tuple(self.spark.read.schema(s).parquet(f"{self.path}/{found[-1].folder}/{name}") for name, s in self.schemas.items())

    def put(self, nodes: DataFrame, edges: DataFrame, batch: str, notes: dict) -> Snapshot:
        """Writes both tables, which may read the newest snapshot, and commits them with ``notes``."""
        snapshot_id, folder = self.log.new_folder(batch)
        rows = 0
        for name, df in (("nodes", nodes), ("edges", edges)):
            seen = Observation()
            out = df.select(*self.schemas[name].names).observe(seen, F.count(F.lit(1)).alias("rows"))
            out.write.parquet(f"{self.path}/{folder}/{name}")
            rows += seen.get["rows"]
        return self.log.add(snapshot_id, batch, rows, folder, notes)

    def notes(self) -> list[dict]:
        """Of all commits, also of snapshots that have expired, oldest first."""
        return [e["notes"] | {"committed_ms": e["committed_ms"]} for e in self.log.entries() if "snapshot_id" in e]

    def mark(self) -> datetime | None:
        """The time of the newest batch applied, in UTC."""
        found = [n["mark_us"] for n in self.notes() if n.get("mark_us") is not None]
        return datetime.fromtimestamp(max(found) / 1_000_000, timezone.utc) if found else None

    def applied(self, source: str) -> int:
        """The number of the stream's last batch that was applied; -1 before the first."""
        return max((n["number"] for n in self.notes() if n.get("source") == source), default=-1)

    def checkpoints(self) -> DataFrame:
        """A row for each commit that applied changes."""
        rows = [(n["batch_job"], datetime.fromtimestamp(n["committed_ms"] / 1000, timezone.utc), n["new"], n["removed"], n["changed"]) for n in self.notes() if n.get("batch_job") is not None]
        return self.spark.createDataFrame(rows, CHECKPOINT)
