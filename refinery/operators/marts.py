"""Frequency and enrichment marts, edges and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions import text as X

TOTAL = "TOTAL"


def usage(df: DataFrame, category: str, items: str) -> DataFrame:
    """A1, P10, A2, A3: (category_id, ingredient_name, usage_count, is_total) for each category and over all, in one pass.

    items: an array, which is exploded, or one item a row. The total is told by grouping(), so that a
    category that is null or called TOTAL stays apart.
    """
    item = F.explode(items) if isinstance(df.schema[items].dataType, T.ArrayType) else F.col(items)
    rows = df.select(F.col(category).alias("category_id"), item.alias("ingredient_name")).where(X.countable_item(F.col("ingredient_name")))
    sets = rows.groupingSets([["category_id", "ingredient_name"], ["ingredient_name"]], "category_id", "ingredient_name")
    return sets.agg(F.count(F.lit(1)).alias("usage_count"), (F.grouping("category_id") == 1).alias("is_total"))


def top_per_category(counts: DataFrame, k: int = 50) -> DataFrame:
    """Rank by count, then name; the total is labelled TOTAL."""
    best = Window.partitionBy("is_total", "category_id").orderBy(F.desc("usage_count"), F.asc("ingredient_name"))
    label = F.when(F.col("is_total"), F.lit(TOTAL)).otherwise(F.col("category_id"))
    return counts.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select(label.alias("category_id"), "ingredient_name", "usage_count", "rank")


def read_back(frequency: DataFrame, category: str | None = None, n: int = 10) -> DataFrame:
    """W3, P14."""
    rows = frequency.where(F.col("rank") <= n)
    return rows if category is None else rows.where(F.col("category_id") == category)


def distinct_usage(rows: DataFrame, item: str, owner: str) -> DataFrame:
    """A4: exact number of different owners of each item; a null item is a group."""
    return rows.groupBy(F.col(item).alias("ingredient_name")).agg(F.countDistinct(owner).alias("usage_count"))


def usage_sketches(rows: DataFrame, item: str, owner: str, size: int = 14) -> DataFrame:
    """A4, opt-in: (ingredient_name, owners), a HyperLogLog sketch of each item's different owners, of at most 2 ** size registers. Sketches of batches are kept and merged, so that a count over all of them rereads none."""
    return rows.where(F.col(owner).isNotNull()).groupBy(F.col(item).alias("ingredient_name")).agg(F.hll_sketch_agg(owner, size).alias("owners"))


def merged_usage(sketches: DataFrame) -> DataFrame:
    """(ingredient_name, usage_count) from the sketches of any number of batches: different owners over all of them. The standard error is 1.04 / sqrt(2 ** size), 0.8 % for 14; up to some hundreds counts are exact as a rule."""
    return sketches.groupBy("ingredient_name").agg(F.hll_sketch_estimate(F.hll_union_agg("owners")).alias("usage_count"))


def enrich(counts: DataFrame, metadata: DataFrame, name: str) -> DataFrame:
    """Metadata of each item; several rows of metadata give several rows, none gives nulls."""
    return counts.join(metadata, counts["ingredient_name"] == metadata[name], "left")


def edges(rows: DataFrame, lookup: DataFrame, owner: str, item: str, name: str, target: str) -> DataFrame:
    """Distinct (owner, target) of items that the lookup knows."""
    found = rows.where(F.col(item).isNotNull()).join(lookup.where(F.col(target).isNotNull()), rows[item] == lookup[name])
    return found.select(F.col(owner), F.col(target)).distinct()


def share(df: DataFrame, c: Column) -> DataFrame:
    """(n, matched, share) of rows with a value."""
    n, matched = F.count(F.lit(1)), F.count(c)
    return df.agg(n.alias("n"), matched.alias("matched"), X.rate(matched, n).alias("share"))
