"""Batch identity and retention."""

from __future__ import annotations

from datetime import date, datetime, timezone
from re import search

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def batch_date(injected: str | None, run_id: str | None, now: datetime | None = None) -> date:
    """B1: the injected date, else that in the run's id (eight digits), else today in UTC."""
    if injected:
        return date.fromisoformat(injected[:10])
    if run_id and (found := search(r"(\d{8})", run_id)):
        return datetime.strptime(found[1], "%Y%m%d").date()
    return (now or datetime.now(timezone.utc)).date()


def stamp(df: DataFrame, batch_job: str, batch_date: Column) -> DataFrame:
    """P15."""
    return df.withColumns({"batch_job": F.lit(batch_job), "batch_date": batch_date})


def retention_candidates(snapshots: DataFrame, table: str, taken_at: str, cutoff: Column, keep: int = 2) -> DataFrame:
    """B2: snapshots before the cutoff, but for each table's newest ``keep``. A report: nothing is deleted."""
    newest = Window.partitionBy(table).orderBy(F.desc(taken_at))
    return snapshots.withColumn("_n", F.row_number().over(newest)).where((F.col("_n") > keep) & (F.col(taken_at) < cutoff)).drop("_n")
