"""Record streams as Structured Streaming jobs.

``process_records`` is the one stateless transformation (parse, validate,
route) used by both the batch job (R2) and the stream (R1): a stream is a
``readStream`` of JSON-lines files feeding the same function, written through
``foreachBatch``.

Sinks are idempotent per micro-batch: each batch writes its own folder
``batch_id=<n>`` with overwrite, so a batch replayed after a failure (same
id, same input, per the checkpoint) replaces its earlier partial output
instead of duplicating it. Triggers use ``availableNow`` so a run drains what
is there and stops; ``maxFilesPerTrigger`` bounds each micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import validate as V


def process_records(df: DataFrame, rules: Sequence[dict], parse: Callable[[DataFrame], DataFrame] | None = None,
                    route: Callable[[DataFrame], F.Column] | None = None) -> DataFrame:
    """R2: per-record failure isolation: a bad record gets violations instead
    of failing the batch; optional parse and routing steps."""
    out = parse(df) if parse else df
    out = V.validate(out, rules)
    if route is not None:
        out = out.withColumn("entity_type", route(out))
    return out


def read_jsonl_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    """R1 source: JSON-lines files arriving in ``path``; malformed lines dropped."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .option("mode", "DROPMALFORMED")
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]").json(path))


def batch_folder_sink(output: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer, one overwrite folder per batch id (idempotent)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{output.rstrip('/')}/batch_id={batch_id}")
    return write


def stats_sink(output: str, group_cols: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Per-batch counts (by ``group_cols``) written as a small table per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n")) \
            .withColumn("batch_id", F.lit(batch_id).cast("long"))
        counts.write.mode("overwrite").parquet(f"{output.rstrip('/')}/batch_id={batch_id}")
    return write


def fan_out(*sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Several sinks for one micro-batch; the batch is persisted once and
    released afterwards."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for s in sinks:
                s(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                  name: str | None = None) -> list[dict]:
    """Drain everything available, then stop; returns the progress reports of all micro-batches, in order.

    Spark keeps only the last reports of a query (``spark.sql.streaming.numRecentProgressUpdates``, 100 by default), so they
    are gathered at each batch: a batch's report is there before the next batch begins."""
    reports: dict[tuple, dict] = {}
    started: list = []

    def gather() -> None:
        for q in started:
            for p in q.recentProgress:
                p = p if isinstance(p, dict) else p.__dict__
                reports[p["batchId"], p["timestamp"]] = p

    def gathering_sink(batch: DataFrame, batch_id: int) -> None:
        gather()
        sink(batch, batch_id)

    w = stream.writeStream.foreachBatch(gathering_sink).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    q = w.start()
    started.append(q)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    gather()
    return [reports[k] for k in sorted(reports)]


def upsert_sink(spark: SparkSession, to_rows: Callable[[DataFrame], DataFrame], root: str) -> Callable[[DataFrame, int], None]:
    """Each micro-batch is upserted into the entity store, of which only the shards its ids fall in are read. A replayed
    batch finds its ids there and adds nothing."""
    from ..sources import store

    def write(batch: DataFrame, batch_id: int) -> None:
        store.upsert(spark, to_rows(batch), root)
    return write
