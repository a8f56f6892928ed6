"""Helpers shared by the operators: staged tables, tokens, distributed ranks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Java regular expression of a run of white space and its characters.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the session's shared checkpoint folder
    and read it back.

    Cuts lineage (a lost executor costs nothing that was written), and later
    readers prune columns.  The files go when the driver's JVM ends; shuffle
    files of the steps before it are released now, not at some later garbage
    collection.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    for _ in range(2):  # after one collection the shuffles are still held (measured)
        spark._jvm.System.gc()
    return out


def release(*frames: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._staged_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only; a text of ASCII alone takes the quick way."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, UPPER, UPPER.lower())))


def space_words(c: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank give none."""
    t = F.btrim(F.coalesce(c, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(F.length(t) > 0, F.split(t, SPACES)).otherwise(
        F.array().cast("array<string>"))


def range_numbered(df: DataFrame, order: list, out: str = "rn") -> DataFrame:
    """``out`` = 0, 1, 2 ... in the order of the columns, with no single task
    that sorts all rows: range partitions are written once (their boundaries
    are sampled once), numbered locally, and shifted by the rows before them.
    """
    spark = df.sparkSession
    part = staged(df.repartitionByRange(shuffle_parts(spark), *order)
                  .withColumn("_p", F.spark_partition_id()))
    # one row per partition: a bounded window
    sizes = part.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_b"))
    local = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return (part.withColumn("_r", local).join(F.broadcast(sizes), "_p")
            .withColumn(out, F.col("_r") + F.col("_b")).drop("_p", "_r", "_b"))
