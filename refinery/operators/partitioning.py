"""Dealing rows to tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def spread(df: DataFrame) -> DataFrame:
    """For heavy work on each row: a table that would be read by fewer tasks than there are cores is dealt to all of them; any other stays as it is.

    Files are cut into parts of spark.sql.files.maxPartitionBytes, so a few large ones are no reason. Nothing runs to find out.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    files = df.inputFiles()
    if len(files) >= cores:
        return df
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    part = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    tasks = 0
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        tasks += max(path.getFileSystem(conf).getFileStatus(path).getLen() // part, 1)
    return df if tasks >= cores else df.repartition(cores)


def dealt(df: DataFrame, *by: str | Column) -> DataFrame:
    """By the given columns to as many tasks as the session shuffles to, and no fewer: for work that holds several orders and tables of its rows at once, of which merged partitions would need that many times more memory."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)
