"""Intermediate tables in the folder that driver and executors share, and global row numbers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in local mode, where it is unset, a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-scratch-', dir='/tmp')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read it again. Joins sort and merge it, as Spark takes a table's
    size from its packed files: a table of few MB there may take the driver hundreds to broadcast."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).hint("merge")


def tasks_for(df: DataFrame, rows: int = 500_000) -> int:
    """As many tasks as the rows of a table need, at least one a core, to give to repartition. Spark's own tasks grow with the table
    until they hold some MB of packed rows, which are many times that once they are sorted or grouped."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def numbered(df: DataFrame, order: list, name: str = "place") -> DataFrame:
    """df with the rows' places in an order, from 0, without a task that sees them all: rows are sorted within ranges, and
    each range starts behind the sizes of those before it. The sizes are one row per partition."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("__range", F.spark_partition_id()).withColumn("__in", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    ranged = stored(ranged, "numbered")
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__range", before.alias("__before"))
    return ranged.join(F.broadcast(starts), "__range").withColumn(name, F.col("__before") + F.col("__in")).drop("__range", "__in", "__before")
