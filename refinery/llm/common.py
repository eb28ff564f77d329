"""What the operators share: reading tables, staging tables in the shared folder, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where it is unset in local mode."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    named = tempfile.mkdtemp(prefix="spark-shared-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def unused(df: DataFrame, name: str) -> str:
    """The name with as many underscores before it as it takes to be no column of df; Spark's names disregard case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Spark's setting by which a job's shuffle files go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Staged:
    """A table written to the shared folder: later reads start there, and a lost executor costs no more than a reread. What was shuffled for it is deleted, as nothing reads that again."""

    def __init__(self, df: DataFrame) -> None:
        self.spark = df.sparkSession
        self.path = f"{shared_folder(self.spark)}/stage-{uuid.uuid4().hex}"
        kept = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(self.path)
        finally:
            self.spark.conf.set(CLEANUP, kept)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Deletes the files, once nothing that is still to run reads them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame) -> DataFrame:
    return Staged(df).df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of a round's least neighbours that are broadcast to the links; beyond that they are joined by shuffles.
MOST_LEAST = 100_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected graph edges(a, b), staged: component is the smallest node reachable.

    Alternating large-star and small-star steps; each round is written to the shared folder, so
    lineage stays short. Rounds grow with the logarithm of the longest path and end as soon as all
    links are stars around their least nodes, which the least neighbours tell. Each step groups with
    partial sums and joins on the node, so a node with very many links is split by the skew join.
    Loops and nulls are ignored; nodes without links are not returned.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = Staged(e)
    while True:
        down = now.df.select("u", "v", F.lit(1).alias("down"))
        both = down.unionByName(now.df.select(F.col("v").alias("u"), F.col("u").alias("v"), F.lit(0).alias("down")))
        of = both.groupBy("u").agg(F.min("v").alias("m"), F.sum("down").alias("below"), F.count("*").alias("links"))
        least = Staged(of.select("u", F.least("u", "m").alias("m"), (F.col("below") > 0).alias("leaf"), "links"))
        nodes, tangled = least.df.agg(F.count("*"), F.count_if(F.col("leaf") & (F.col("links") > 1))).first()
        if not tangled:
            now.drop()
            return least.df.select(F.col("u").alias("node"), F.col("m").alias("component"))
        few = F.broadcast if nodes <= MOST_LEAST else lambda t: t
        # Each link goes on once, from its upper end, so there is nothing to make distinct.
        large = both.select("u", "v").join(few(least.df.select("u", "m")), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        both_ends = F.explode(F.array(F.col("u"), F.col("v"))).alias("u")
        small = large.join(few(low), "u").select(both_ends, "m").where("u <> m").select("u", F.col("m").alias("v")).distinct()
        after = Staged(small)
        now.drop()
        least.drop()
        now = after
