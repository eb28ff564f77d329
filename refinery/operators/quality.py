"""Data-quality metrics in long form."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions import text as X


def stage_metrics(routed: DataFrame, error: str = "error_type") -> DataFrame:
    """Q1: loaded, ok, errors and error_rate in one row."""
    bad = F.count(F.col(error))
    n = F.count(F.lit(1))
    return routed.agg(n.alias("loaded"), (n - bad).alias("ok"), bad.alias("error"), X.rate(bad, n).alias("error_rate"))


def mapping_metrics(mart: DataFrame, item: str, matched_by: str) -> DataFrame:
    """Q2: each item once, whatever the number of its metadata rows."""
    items = mart.groupBy(item).agg(F.max(F.col(matched_by).isNotNull().cast("int")).alias("_hit"))
    n, hit = F.count(F.lit(1)), F.coalesce(F.sum("_hit"), F.lit(0))
    return items.agg(n.alias("ingredients_unique"), hit.alias("matched"), (n - hit).alias("unmatched"), X.rate(hit, n).alias("match_rate"))


def long_form(wide: DataFrame, stage: str, run_id: str, batch_date: Column, target: str, created_at: Column) -> DataFrame:
    """Q3: a row for each metric."""
    doubles = wide.select(*[F.col(c).cast("double") for c in wide.columns])
    rows = doubles.unpivot([], doubles.columns, "metric_name", "metric_value")
    return rows.select(batch_date.alias("batch_date"), F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), "metric_name", "metric_value", F.lit(target).alias("target_table"), created_at.alias("created_at"))


def try_write(write: Callable[[], None]) -> bool:
    """Q4: metrics never fail the job; False and a warning if they could not be written."""
    try:
        write()
    except Exception:
        logging.getLogger(__name__).warning("metrics were not written", exc_info=True)
        return False
    return True


def drill_down(metrics: DataFrame, rows: DataFrame) -> DataFrame:
    """Q5: rows of the batches that the metrics name."""
    return rows.join(metrics.select("batch_date").distinct(), "batch_date", "left_semi")
