"""A place for tables that a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession) -> str:
    """A new name below the folder in spark.checkpoint.dir, which driver and executors share; a temporary folder only in local mode, where it is unset."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    return f"{named}/scratch-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """The same rows, written once and read from there, so that what uses them several times does not make them anew."""
    to = new_folder(df.sparkSession)
    df.write.parquet(to)
    return df.sparkSession.read.schema(df.schema).parquet(to)
