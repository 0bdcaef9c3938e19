"""Stream equals batch; per-batch sinks are idempotent."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fedlake.session import scratch_path
from fedlake.sources import sinks
from fedlake.streaming import process as S

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])
RULES = [{"field": "v", "type": "range", "params": {"min": 0, "max": 10}}]


def test_stream_matches_batch(spark):
    src = scratch_path(spark, "t-stream-src")
    data = spark.range(0, 200).select(F.col("id"), (F.col("id") % 13).cast("double").alias("v"))
    sinks.write_json(data.repartition(3), src)
    out = scratch_path(spark, "t-stream-out")
    stream = S.process_records(S.read_jsonl_stream(spark, src, SCHEMA, max_files=1), RULES)
    progress = S.run_available(stream.select("id", F.size("violations").alias("n")), S.batch_folder_sink(out),
                               scratch_path(spark, "t-stream-ckpt"))
    assert len(progress) >= 3  # one file per micro-batch
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("id", "n").collect())
    want = sorted(tuple(r) for r in S.process_records(data, RULES).select("id", F.size("violations")).collect())
    assert got == want


def test_batch_sink_replay_is_idempotent(spark):
    out = scratch_path(spark, "t-replay")
    sink = S.batch_folder_sink(out)
    batch = spark.range(0, 10)
    sink(batch, 7)
    sink(batch, 7)  # the same batch id replayed after a failure
    assert spark.read.parquet(out).count() == 10


def test_progress_of_more_batches_than_spark_keeps(spark):
    """Reports of every micro-batch are returned, however few of them Spark itself keeps."""
    src = scratch_path(spark, "t-many-batches")
    spark.range(0, 12).select(F.col("id")).repartition(6).write.option("maxRecordsPerFile", 2).json(src)
    key, seen = "spark.sql.streaming.numRecentProgressUpdates", []
    old = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        stream = S.read_jsonl_stream(spark, src, "id long", max_files=1)
        progress = S.run_available(stream, lambda b, i: seen.append(b.count()), scratch_path(spark, "t-many-ckpt"))
    finally:
        spark.conf.set(key, old)
    assert len(seen) >= 6 and sum(seen) == 12
    assert [p["numInputRows"] for p in progress if p["numInputRows"]] == seen
