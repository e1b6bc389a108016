"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAPS = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BROADCAST_ROWS, BROADCAST_CHARS = 200_000, 32_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir, or one of our own in local mode where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-scratch-', dir='/tmp')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str, long_rows: bool = False) -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read it again. long_rows: rows of many MB, of which
    writers and readers hold a few at a time only."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if long_rows:
        writer = writer.option("parquet.block.size", str(16 << 20)).option("parquet.page.size.row.check.min", "1")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, rows: int = BROADCAST_ROWS, chars: int = BROADCAST_CHARS) -> DataFrame:
    """df with a broadcast hint if it is measured to hold few rows and little text; otherwise Spark shuffles it. Give a
    written table."""
    n, size = df.limit(rows + 1).agg(F.count("*"), F.sum(F.length(F.to_json(F.struct(*df.columns))))).first()
    return F.broadcast(df) if n <= rows and (size or 0) <= chars else df


def free_name(names: list[str], name: str) -> str:
    """name, with underscores until none of names equals it in any case."""
    taken = {n.lower() for n in names}
    while name.lower() in taken:
        name += "_"
    return name


def value_key(*cols: str) -> list[Column]:
    """128 bits that name a row by its values: equal rows have equal keys, whatever task reads them."""
    return [F.xxhash64(*cols).alias("k1"), F.xxhash64(F.lit(7), *reversed([F.col(c) for c in cols])).alias("k2")]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; texts of one byte a character take the faster built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column, gaps: str = GAPS) -> Column:
    """What stands between gaps; none in a null. A split takes a fifth of the time that extracting or counting matches does."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gaps), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def bind(value: Column, body) -> Column:
    """body(value) with value computed once: a column used several times inside lambdas would be computed again each time."""
    return F.element_at(F.transform(F.array(value), body), 1)
