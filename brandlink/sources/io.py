"""Stage inputs and outputs.

Between stages the pipeline writes parquet; ``;``-separated CSV is offered
for exchange with the original notebooks' files.  CSV is always read with an
explicit schema so an all-digit brand such as ``1664`` stays a string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PAIR_SCHEMA = T.StructType([
    T.StructField("left_side", T.StringType()),
    T.StructField("right_side", T.StringType()),
])


def similarity_schema(column: str = "similarity") -> T.StructType:
    return T.StructType(PAIR_SCHEMA.fields + [T.StructField(column, T.DoubleType())])


LABEL_SCHEMA = T.StructType(PAIR_SCHEMA.fields + [T.StructField("target", T.IntegerType())])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";") -> DataFrame:
    """Lazy CSV scan with header and a fixed schema."""
    return (spark.read.schema(schema).option("header", True).option("sep", sep)
            .option("mode", "FAILFAST").csv(path))


def write_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    """CSV export (S4).  Written in parallel, one file per partition; pair
    tables are never coalesced to one task."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet stage output."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
