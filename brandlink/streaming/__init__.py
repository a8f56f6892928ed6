"""Streaming.

The original pipeline reads every input once, in batch; it has no stream
source, watermark, window or state, so no streaming operator is owed.  The
one place where arriving data fits naturally is the catalogue layers: they
are row-local (no aggregation), so new catalogue files can be cleaned into
the gold layer incrementally with :func:`gold_stream`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import Config
from ..operators.catalog import gold


def gold_stream(spark: SparkSession, raw_dir: str, schema, cfg: Config) -> DataFrame:
    """Streaming read of raw catalogue parquet files (``retailer, ean,
    brand_name, crumb``) through the same silver/gold expressions.  Stateless:
    the caller chooses the sink and checkpoint location."""
    raw = spark.readStream.schema(schema).parquet(raw_dir)
    return gold(raw, cfg)
