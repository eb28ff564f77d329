"""Writing tables: batches in partitions of a history, and exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.schemas import Table, conform, enforce_not_null
from refinery.sources.snapshots import Snapshot, SnapshotLog

#: Names of tables by which buckets are written and read begin so.
TABLE = "refinery_snapshot"
BATCH = T.StructField("_batch", T.StringType())


class BatchStore:
    """A table as Parquet with a snapshot for each write of a batch; current is the newest.

    A snapshot is written to a folder of its own and counts once its commit is in the log, so a write that
    fails, also over a batch that is there, changes nothing for readers. Of a batch's snapshots the newest is its
    rows; earlier ones stay readable by id until they expire. Newest is by commit, not by name. ``by`` names
    columns, or columns to be derived, whose values part a batch's files; ``sort`` orders the rows within files.

    ``buckets``, a column and a number, lays every snapshot out by key, so that joins and groupings of snapshots
    by it need no shuffle. ``derived`` are columns that are made once, when a row is written, and read only
    where they are asked for.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, sort: list[Column] = (), by: dict[str, Column | None] | None = None, buckets: tuple[str, int] | None = None, derived: dict[str, Column] | None = None
    ) -> None:
        self.spark, self.path, self.schema, self.sort, self.by = spark, path, schema, list(sort), by or {}
        self.buckets, self.derived = buckets, derived or {}
        self.log = SnapshotLog(spark, path)

    @classmethod
    def of(cls, spark: SparkSession, root: str, table: Table) -> BatchStore:
        """The store of one of the declared tables below ``root``."""
        return cls(spark, f"{root}/{table.name}", table.schema, [F.col(c).asc_nulls_last() for c in table.sort], table.by())

    def create(self, replace: bool = False) -> bool:
        """The typed empty table where there is none, or instead of what is there; whether it was made."""
        if self.log.exists(self.path):
            if not replace:
                return False
            self.drop()
        # Readers pass over names that begin with an underscore and hold no value.
        self.spark.createDataFrame([], self.schema).write.parquet(f"{self.path}/_schema")
        return True

    def drop(self) -> None:
        """The table and all its batches go."""
        self.log.delete(self.path)

    def _write(self, df: DataFrame, batch: str) -> tuple[str, str, int]:
        """(id, folder, rows) of what was written and is not yet part of the table. Rows are counted as they are written."""
        snapshot_id, folder = self.log.new_folder(batch)
        rows = enforce_not_null(conform(df, self.schema), self.schema).withColumns(self.derived)
        parts = [name if c is None else f"_{name}" for name, c in self.by.items()]
        rows = rows.withColumns({f"_{name}": c for name, c in self.by.items() if c is not None})
        if self.buckets:
            # A task for each bucket, and so a file for each bucket (and part).
            rows = rows.repartition(self.buckets[1], self.buckets[0])
        if self.sort or parts:
            rows = rows.sortWithinPartitions(*parts, *self.sort)
        seen = Observation()
        writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write
        writer = writer.partitionBy(*parts) if parts else writer
        if self.buckets:
            # Spark writes buckets by way of a table; its name goes again, the files stay.
            name = f"{TABLE}_{snapshot_id}"
            writer.format("parquet").option("path", f"{self.path}/{folder}").bucketBy(self.buckets[1], self.buckets[0]).sortBy(self.buckets[0]).saveAsTable(name)
            self.spark.sql(f"drop table {name}")
        else:
            writer.parquet(f"{self.path}/{folder}")
        return snapshot_id, folder, seen.get["rows"]

    def append(self, df: DataFrame, batch: str, skip_empty: bool = True) -> bool:
        """K1, K2: adds the batch in the table's schema; an empty one is skipped, so that current stays. The same batch again is not added twice."""
        snapshot_id, folder, rows = self._write(df, batch)
        if skip_empty and not rows:
            self.log.delete(f"{self.path}/{folder}")
            return False
        self.log.add(snapshot_id, batch, rows, folder)
        return True

    def overwrite(self, df: DataFrame, batch: str, notes: dict | None = None) -> Snapshot:
        """K3: the batch becomes what ``df`` is, even if that is empty; earlier ones stay readable. ``df`` may read this batch; ``notes`` go into the commit."""
        snapshot_id, folder, rows = self._write(df, batch)
        return self.log.add(snapshot_id, batch, rows, folder, notes)

    def _fields(self, derived: bool) -> list[T.StructField]:
        made = self.spark.createDataFrame([], self.schema).withColumns(self.derived).schema.fields[len(self.schema.fields) :] if derived else []
        return [T.StructField(f.name, f.dataType) for f in [*self.schema.fields, *made]]

    def _bucketed(self, s: Snapshot, fields: list[T.StructField]) -> DataFrame:
        """A snapshot by way of a table that knows of its buckets."""
        name = f"{TABLE}_{s.snapshot_id}"
        every = self._fields(True)
        parts = [T.StructField(f"_{n}", self.spark.createDataFrame([], self.schema).select(c).schema[0].dataType) if c is not None else None for n, c in self.by.items()]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*every, *[p for p in parts if p]])
        parted = f"partitioned by ({', '.join(f'`{n if c is None else "_" + n}`' for n, c in self.by.items())})" if self.by else ""
        key, number = self.buckets
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"create table {name} ({columns}) using parquet {parted} clustered by (`{key}`) sorted by (`{key}`) into {number} buckets location '{self.path}/{s.folder}'")
            if self.by:
                self.spark.sql(f"msck repair table {name}")
        return self.spark.table(name).select(*[f.name for f in fields], F.lit(s.batch).alias("_batch"))

    def _rows(self, snapshots: list[Snapshot], derived: bool = False) -> DataFrame:
        fields = self._fields(derived)
        if not snapshots:
            return self.spark.createDataFrame([], T.StructType([*fields, BATCH]))
        if self.buckets:
            return reduce(DataFrame.unionByName, [self._bucketed(s, fields) for s in snapshots])
        # Columns that part the files come last in what is read, and derived ones are not the table's.
        read = self.spark.read.schema(T.StructType([*fields, BATCH])).option("basePath", self.path).parquet(*[f"{self.path}/{s.folder}" for s in snapshots])
        return read.select(*[f.name for f in fields], "_batch")

    def history(self, version: int | None = None, derived: bool = False) -> DataFrame:
        """All batches, each as last written (until commit ``version``), with _batch."""
        return self._rows(self.log.live(version), derived)

    def batches(self) -> list[str]:
        """Newest commit first; a reading of the log, not of rows."""
        return [s.batch for s in reversed(self.log.live())]

    def latest_two(self) -> tuple[Snapshot, Snapshot] | None:
        """(previous, newest) batch by commit, or None where there are not two."""
        live = self.log.live()
        return (live[-2], live[-1]) if len(live) > 1 else None

    def read(self, batch: str) -> DataFrame:
        return self._rows([s for s in self.log.live() if s.batch == batch]).drop("_batch")

    def read_snapshot(self, snapshot_id: str, derived: bool = False) -> DataFrame:
        """The rows of one snapshot, also of one that a later write of its batch replaced."""
        found = [s for s in self.log.snapshots() if s.snapshot_id == snapshot_id]
        if not found:
            raise ValueError(f"no snapshot {snapshot_id} in {self.path}; it may have expired")
        return self._rows(found, derived).drop("_batch")

    def current(self, derived: bool = False) -> DataFrame:
        return self._rows(self.log.live()[-1:], derived).drop("_batch")


def export_csv(df: DataFrame, path: str, taken_at: str | None = None) -> str:
    """Arrays joined with |, maps and structs as JSON; with ``taken_at`` (as 20240131_235959) in a folder of that name below path. Returns where."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws("|", F.transform(c, lambda x: x.cast("string")) if not isinstance(f.dataType.elementType, (T.ArrayType, T.MapType, T.StructType)) else F.transform(c, lambda x: F.to_json(x)))
        elif isinstance(f.dataType, (T.MapType, T.StructType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    to = f"{path}/{taken_at}" if taken_at else path
    df.select(*out).write.option("header", True).mode("overwrite").csv(to)
    return to


def export_graph_csv(df: DataFrame, header: list[str], path: str) -> None:
    """A one-row header, and the rows without one."""
    df.sparkSession.createDataFrame([tuple(header)], ", ".join(f"c{n} string" for n in range(len(header)))).coalesce(1).write.option("header", False).mode("overwrite").csv(f"{path}/header")
    df.write.option("header", False).mode("overwrite").csv(f"{path}/data")
