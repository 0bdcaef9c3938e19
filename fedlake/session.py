"""Spark session, table loading and lineage checkpoints.

Nothing here is engine machinery: it is the handful of settings every job in
the library relies on (UTC session time, AQE with skew-join splitting, ANSI
mode kept on) and a reliable checkpoint helper that writes to the cluster's
shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import threading
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import ExitStack, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot keys: AQE splits an oversized shuffle partition of a join side
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    # bytes as compressed for the exchange: rows that are widened after it grow several times in a task's memory
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # a join side is broadcast by Spark's own check: file sizes times this factor, or bytes seen at run time
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # batches for Python workers are bounded by bytes: rows may hold whole texts
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "fedlake") -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("FEDLAKE_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The session's own setting wins. Where it is unset a private scratch folder
    is used, but only for a local master: on a cluster every executor would
    write to its own disk, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif re.fullmatch(r"local(\[.*\])?", sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fedlake-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: functions
    that run there are pickled by reference to it, and a worker does not see the
    driver's own import path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    # executors fetch the file from the driver whenever they start, so it stays until the driver ends
    tmp = tempfile.mkdtemp(prefix="fedlake-package-")
    atexit.register(shutil.rmtree, tmp, ignore_errors=True)
    path = os.path.join(tmp, "fedlake.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for n in sorted(names):
                if n.endswith((".py", ".yaml")):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/fedlake-tables/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_HELD: dict[tuple[str, str], list] = {}
_HELD_LOCK = threading.Lock()


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Inside, the session has ``value`` for ``key``. May be nested, and entered by several threads."""
    with _HELD_LOCK:
        held = _HELD.setdefault((spark.sparkContext.applicationId, key), [0, None])
        if not held[0]:
            held[1] = spark.conf.get(key, None)
        spark.conf.set(key, value)
        held[0] += 1
    try:
        yield
    finally:
        with _HELD_LOCK:
            held[0] -= 1
            if not held[0]:
                if held[1] is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, held[1])


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark removes a write's shuffle files when the write ends, instead of when the driver's next garbage
    collection finds them unused. For writes whose plan is not run again: a job that writes one table after the other
    then holds the shuffles of one. May be nested, and entered by several threads."""
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


#: Bytes of an input's files that get an exchange partition of their own, the bytes up to which partitions are joined, and
#: those that a task reads: with many partitions the writer of an exchange sorts what it read.
EXCHANGE_INPUT = 4 << 20
EXCHANGE_TASK = "8m"
EXCHANGE_READ = "32m"


@contextmanager
def exchanges_for(spark: SparkSession, n_bytes: int) -> Iterator[None]:
    """Inside, a write's exchanges have as many partitions as an input of ``n_bytes`` needs, if these are more than the
    session's, and adaptive execution joins them up to EXCHANGE_TASK: what a task sorts and groups stays as large while the
    input grows. For plans that exchange rows of numbers, which take many times their compressed size in memory. What the
    driver or the cluster set itself is left."""
    given = dict(spark.sparkContext.getConf().getAll())
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // EXCHANGE_INPUT))
    wanted = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": EXCHANGE_TASK,
              "spark.sql.files.maxPartitionBytes": EXCHANGE_READ}
    with ExitStack() as held:
        for key, value in wanted.items():
            if given.get(key) in (None, DEFAULT_CONF.get(key)):
                held.enter_context(_setting(spark, key, value))
        yield


def path_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files under the paths."""
    total = 0
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return total


def table_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Bytes of the files of a table of the given folder."""
    return path_bytes(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def delete_path(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Bytes of a table's files whose rows are exchanged at a time by steps that work in slices.
SLICE_BYTES = 2 << 30


def slices_for(n_bytes: int) -> int:
    """How many slices a table of so many bytes is worked on in."""
    return max(1, -(-n_bytes // SLICE_BYTES))


def in_slice(keys: Sequence[Column], part: int, of: int) -> Column:
    """Whether a row is of slice ``part`` of ``of``, by its keys' hash: rows with the same keys are of the same slice."""
    from pyspark.sql import functions as F

    return F.pmod(F.xxhash64(*keys), F.lit(of)) == part


def materialize(df: DataFrame | Sequence[DataFrame], name: str = "table", partition_by: tuple[str, ...] = (),
                path: str | None = None, compression: str | None = None) -> tuple[DataFrame, int]:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read
    it back, cutting the lineage; the row count is observed during that one
    write job (no second pass). Survives executor loss: the files are on
    shared storage. ``partition_by`` columns of few values become folders, so
    that a reader of one value reads (and sizes) its files only. Several frames of
    one schema are written one after the other, and each one's exchanges go with its write.
    ``compression`` (default: the session's) of the files: zstd halves hexadecimal ids, which snappy leaves as they are."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    parts = [df] if isinstance(df, DataFrame) else df
    spark = parts[0].sparkSession
    path, rows = path or scratch_path(spark, name), 0
    for k, part in enumerate(parts):
        obs = Observation(f"fedlake_{name}")
        writer = part.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append" if k else "error")
        if compression:
            writer = writer.option("compression", compression)
        with releasing(spark):
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        rows += int(obs.get["rows"])
    # the schema is known; inference would find none where a partitioned table is empty
    return spark.read.schema(parts[0].schema).parquet(path), rows


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[Callable[..., tuple[DataFrame, int]]]:
    """``materialize`` for tables that only the block reads, compressed more: the function it gives is used in its place, and
    what it wrote is deleted at the end."""
    made: list[str] = []

    def write(df: DataFrame | Sequence[DataFrame], name: str = "table", partition_by: tuple[str, ...] = (),
              path: str | None = None) -> tuple[DataFrame, int]:
        made.append(path or scratch_path(spark, name))
        return materialize(df, name, partition_by, made[-1], "zstd")

    try:
        yield write
    finally:
        for path in made:
            delete_path(spark, path)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        load(spark, sf_dir, n).createOrReplaceTempView(n)
