import tempfile

from brandlink.config import FIXTURE_CONFIG
from brandlink.operators.catalog import gold
from brandlink.sources.tables import fixture_catalogue
from brandlink.streaming import gold_stream

SF = "/root/testdata/sf0.001"


def test_gold_stream_matches_batch(spark):
    raw = fixture_catalogue(spark, SF, materialize=False)
    scratch = tempfile.mkdtemp(prefix="brandlink-stream-")
    raw.write.mode("overwrite").parquet(f"{scratch}/raw")
    stream = gold_stream(spark, f"{scratch}/raw", raw.schema, FIXTURE_CONFIG)
    q = (stream.writeStream.format("parquet").option("path", f"{scratch}/gold")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.read.parquet(f"{scratch}/gold")
    exp = gold(raw, FIXTURE_CONFIG)
    assert got.count() == exp.count()
    assert got.exceptAll(exp.select(*got.columns)).count() == 0
