"""Node and edge tables: full export, and changes applied from a checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.functions import text as X
from refinery.operators.partitioning import dealt
from refinery.operators.routing import first_per_key


def nodes(rows: DataFrame, key: str, names: dict[str, str], order: list[Column]) -> DataFrame:
    """G1: one node for each key; names: column -> property."""
    return first_per_key(rows, key, order).select(*[F.col(c).alias(p) for c, p in names.items()])


def last_checkpoint(checkpoints: DataFrame) -> str | None:
    """The batch of the newest sync."""
    return checkpoints.agg(F.max_by("batch_job", "synced_at")).first()[0]


def pending(changes: DataFrame, mark, order: str) -> DataFrame:
    """Changes of batches after the mark (their time, not their label); all without a mark."""
    return changes.where(X.after_mark(F.col(order), mark))


def effective(nodes: DataFrame, changes: DataFrame, key: str, order: str) -> DataFrame:
    """The changes that do something, in each key's own order of batches: CHANGED needs a node, from before or by a NEW since its last REMOVED.

    Adds _turn; _reset: the turn of the key's last REMOVED or CHANGED, from which its edges are made anew; _last: whether
    it is the key's last turn; _stays: whether the key is there after it.
    """
    # Within one batch: CHANGED, NEW, REMOVED.
    in_order = Window.partitionBy(key).orderBy(order, "change_type")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(key)
    kind = F.col("change_type")
    there = nodes.select(F.col(key).alias("_key")).distinct()
    rows = dealt(changes.where(F.col(key).isNotNull()), key).join(there, F.col(key) == F.col("_key"), "left")
    last_event = F.last(F.when(kind != "CHANGED", kind), ignorenulls=True).over(before)
    alive = F.when(last_event.isNull(), F.col("_key").isNotNull()).otherwise(last_event == "NEW")
    rows = rows.withColumn("_alive", alive).where((kind != "CHANGED") | F.col("_alive")).withColumn("_turn", F.row_number().over(in_order))
    # In the order that the rows are in: no sort and no join of their own.
    rows = rows.withColumns({"_reset": F.max(F.when(kind != "NEW", F.col("_turn"))).over(every), "_final": F.max(F.struct("_turn", "change_type")).over(every)})
    return rows.withColumns({"_last": F.col("_turn") == F.col("_final._turn"), "_stays": F.col("_final.change_type") != "REMOVED"}).drop("_key", "_alive", "_final")


def apply(nodes: DataFrame, edges: DataFrame, changes: DataFrame, lookup: DataFrame, key: str, order: str, properties: list[str], items: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) after the changes of any number of batches, each key's in their order. Applying a log again changes nothing, if no CHANGED comes before the NEW of its key.

    NEW puts the node and adds its edges; REMOVED takes both; CHANGED replaces the properties and edges
    of a node that is there. edges are (key, target); lookup is (name, target), and items it does not
    know give no edge.
    """
    done = effective(nodes, changes, key, order)
    last = done.where("_last")
    put = last.where("_stays")
    all_nodes = nodes.join(last.select(key), key, "left_anti").select(key, *properties).unionByName(put.select(key, *properties))
    left = edges.join(last.where("_reset is not null").select(key), key, "left_anti")
    adding = done.where("change_type <> 'REMOVED' and _turn >= coalesce(_reset, 0) and _stays")
    pairs = adding.select(key, F.explode(items).alias("name")).join(lookup, "name").where(F.col("target").isNotNull()).select(key, "target")
    return all_nodes, left.select(key, "target").unionByName(pairs).distinct()


def item_nodes(edges: DataFrame) -> DataFrame:
    """The targets as nodes."""
    return edges.select("target").distinct()


def checkpoint_row(changes: DataFrame, batch: str, synced_at: Column) -> DataFrame:
    """The newest batch applied, with counts."""
    count = lambda kind: F.count_if(F.col("change_type") == kind).cast("int")
    row = changes.agg(F.max(batch).alias("batch_job"), count("NEW").alias("new_count"), count("REMOVED").alias("removed_count"), count("CHANGED").alias("changed_count"))
    return row.where(F.col("batch_job").isNotNull()).select("batch_job", synced_at.alias("synced_at"), "new_count", "removed_count", "changed_count")
