"""Streaming queries (R1-R5) over ``events`` files fed to Structured Streaming.

Each query writes the table as JSON-lines files of a bounded number of records (so their number, and that of the
micro-batches, follows the data) into a fresh folder under the shared checkpoint dir, runs the stream to
completion, and returns what the sink holds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import load, scratch_path
from ..sources import sinks, store
from ..streaming import process as S
from .catalog import register
from .source_queries import EVENT_SCHEMA
from .store_queries import RECIPIENT_SCHEMA

EVENT_RULES = [
    {"field": "value", "type": "range", "params": {"min": 0, "max": 40}, "id": "value:range"},
    {"field": "event_type", "type": "enum", "params": {"values": ["click", "view", "purchase", "signup"]},
     "id": "type:enum", "severity": "warning"},
    {"field": "k", "type": "range", "params": {"max": 90}, "id": "k:range"},
]

_PROCESSED_SQL = (
    "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, "
    "CAST(coalesce(NOT (value BETWEEN 0 AND 40), true) AS INTEGER) + CAST(coalesce(NOT (event_type IN ('click', "
    "'view', 'purchase', 'signup')), true) AS INTEGER) + CAST(coalesce(NOT (CAST(json_extract(props, '$.k') AS "
    "BIGINT) <= 90), false) AS INTEGER) AS n_violations FROM events")


def _parse(df):
    return df.withColumn("k", F.get_json_object("props", "$.k").cast("long"))


def _flat(df):
    return df.select("event_id", "event_type", "k", F.size("violations").alias("n_violations"))


#: Records of an arriving file, and files of a micro-batch.
FILE_RECORDS, BATCH_FILES = 2_000, 8


def _event_files(spark, sf_dir, name):
    path = scratch_path(spark, name)
    sinks.write_json(load(spark, sf_dir, "events"), path, max_records=FILE_RECORDS)
    return path


@register("batch_process", _PROCESSED_SQL)
def q_batch_process(spark, sf_dir):
    """R2: the record-processing function (parse, validate) in batch."""
    return _flat(S.process_records(load(spark, sf_dir, "events"), EVENT_RULES, parse=_parse))


@register("stream_process", _PROCESSED_SQL)
def q_stream_process(spark, sf_dir):
    """The same function on a file stream, several micro-batches, written
    per batch through foreachBatch; the sink read back equals the batch result."""
    src = _event_files(spark, sf_dir, "events-stream")
    out = scratch_path(spark, "events-processed")
    stream = S.process_records(S.read_jsonl_stream(spark, src, EVENT_SCHEMA, max_files=BATCH_FILES), EVENT_RULES, parse=_parse)
    S.run_available(_flat(stream), S.batch_folder_sink(out), scratch_path(spark, "events-ckpt"))
    return spark.read.parquet(out).drop("batch_id")


@register("stream_sink", "SELECT event_id, value FROM events")
def q_stream_sink(spark, sf_dir):
    """Raw records through the per-batch idempotent folder sink."""
    src = _event_files(spark, sf_dir, "events-sink")
    out = scratch_path(spark, "events-raw")
    stream = S.read_jsonl_stream(spark, src, EVENT_SCHEMA, max_files=BATCH_FILES).select("event_id", "value")
    S.run_available(stream, S.batch_folder_sink(out), scratch_path(spark, "events-sink-ckpt"))
    return spark.read.parquet(out).drop("batch_id")


@register("stream_stats",
          "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type")
def q_stream_stats(spark, sf_dir):
    """Per-batch counts per event type, summed over the batches."""
    src = _event_files(spark, sf_dir, "events-stats")
    out = scratch_path(spark, "events-batch-stats")
    data_out = scratch_path(spark, "events-stats-data")
    stream = S.read_jsonl_stream(spark, src, EVENT_SCHEMA, max_files=BATCH_FILES)
    progress = S.run_available(stream, S.fan_out(S.batch_folder_sink(data_out), S.stats_sink(out, ["event_type"])),
                               scratch_path(spark, "events-stats-ckpt"))
    per_batch = spark.read.parquet(out)
    total_in = sum(int(p.get("numInputRows", 0)) for p in progress)
    counted = per_batch.agg(F.sum("n")).first()[0] or 0
    if counted != total_in:
        raise AssertionError(f"batch statistics counted {counted} rows, progress reported {total_in}")
    return per_batch.groupBy("event_type").agg(F.sum("n").cast("bigint").alias("n"))


CUSTOMER_JSON_SCHEMA = "c_custkey long, c_name string, c_acctbal double, c_mktsegment string"


@register("stream_upsert",
          "SELECT c_custkey, c_acctbal FROM customer UNION ALL "
          "SELECT c_custkey, c_acctbal + 1 FROM customer WHERE c_mktsegment = 'AUTOMOBILE'")
def q_stream_upsert(spark, sf_dir):
    """Two arriving folders (all customers; BUILDING unchanged and
    AUTOMOBILE changed) upserted batch by batch into the entity store."""
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    src = scratch_path(spark, "customers-stream")
    sinks.write_json(c, f"{src}/first", max_records=FILE_RECORDS)
    again = c.where(F.col("c_mktsegment") == "BUILDING").unionByName(
        c.where(F.col("c_mktsegment") == "AUTOMOBILE").withColumn("c_acctbal", F.col("c_acctbal") + 1))
    sinks.write_json(again, f"{src}/again", max_records=FILE_RECORDS)
    root = scratch_path(spark, "stream-store")
    stream = (spark.readStream.schema(CUSTOMER_JSON_SCHEMA).option("maxFilesPerTrigger", BATCH_FILES)
              .option("recursiveFileLookup", "true").json(src))
    sink = S.upsert_sink(spark, lambda b: store.to_store_rows(b, "recipient"), root)
    S.run_available(stream, sink, scratch_path(spark, "stream-store-ckpt"))
    return store.list_entities(spark, root, "recipient", RECIPIENT_SCHEMA).select("c_custkey", "c_acctbal")
