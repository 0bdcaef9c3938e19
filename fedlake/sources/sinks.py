"""File sinks.

Writes go through Spark's output committer: a job's files appear together
or not at all (the atomic-rename the source does by hand).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import releasing


def write_csv(df: DataFrame, path: str, fields: Sequence[str] | None = None, mode: str = "error") -> None:
    """S3: CSV with header and a fixed field list (default: the frame's columns);
    an empty input is an error, as in the source."""
    if df.isEmpty():
        raise ValueError("no records to write")
    cols = list(fields or df.columns)
    (df.select(*[F.col(f"`{c}`") for c in cols]).write.mode(mode).option("header", True)
     .option("escape", '"').option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
     # keep values verbatim (Spark trims cell whitespace on write by default)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


JSON_TS_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_json(df: DataFrame, path: str, compress: bool = False, mode: str = "error", max_records: int = 0) -> None:
    """JSON lines, optionally gzip-compressed, and in files of at most ``max_records``."""
    w = (df.write.mode(mode).option("timestampNTZFormat", JSON_TS_NTZ).option("maxRecordsPerFile", max_records)
         .option("timestampFormat", JSON_TS))  # microseconds kept (default writes millis)
    if compress:
        w = w.option("compression", "gzip")
    w.json(path)


def export_views(views: Mapping[str, DataFrame], root: str, fmt: str = "parquet", mode: str = "overwrite",
                 concurrent_jobs: int = 4) -> dict:
    """One folder per named view (the workbook's sheets); returns the paths.

    The views are independent, so their write jobs are submitted together
    (driver threads only submit; Spark's scheduler shares the executors). The exchanges
    of a view go with its write."""
    from concurrent.futures import ThreadPoolExecutor

    def write(item):
        name, df = item
        p = f"{root.rstrip('/')}/{name}"
        w = df.write.mode(mode)
        if fmt == "csv":
            w = w.option("header", True)
        with releasing(df.sparkSession):
            w.format(fmt).save(p)
        return name, p

    with ThreadPoolExecutor(max(1, concurrent_jobs)) as pool:
        return dict(pool.map(write, views.items()))


def entity_csv_line(field_order: Sequence[str]) -> Column:
    """Entity row -> CSV text in a fixed field order, quotes doubled; missing -> ``""``."""
    return F.to_csv(F.struct(*[F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")).alias(f)
                               for f in field_order]), {"escape": '"'})


def entity_from_csv_line(c, field_order: Sequence[str]) -> Column:
    """CSV text -> struct of string fields in the same order."""
    schema = ", ".join(f"`{f}` string" for f in field_order)
    return F.from_csv(F.col(c) if isinstance(c, str) else c, schema, {"escape": '"'})


def iso_text(c: Column, kind: str) -> Column:
    """ISO text like Python's ``isoformat``: dates ``yyyy-MM-dd``; timestamps
    ``yyyy-MM-ddTHH:mm:ss`` with ``.ffffff`` only when there are microseconds."""
    if kind == "date":
        return F.date_format(c, "yyyy-MM-dd")
    micros = F.unix_micros(c.cast("timestamp")) % 1000000
    return F.when(micros == 0, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def _portable(c: Column, kind: T.DataType) -> Column:
    """A value as JSON holds it, at any depth: decimals as strings, dates and timestamps as ISO text."""
    if isinstance(kind, T.DecimalType):
        return c.cast("string")
    if isinstance(kind, T.DateType):
        return iso_text(c, "date")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(c, "timestamp")
    if isinstance(kind, T.StructType):
        made = F.struct(*[_portable(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), made)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _portable(x, kind.elementType))
    return c


def entity_json(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Entity row -> JSON: decimals as strings, dates and timestamps as
    ISO text (nested ones too), nested structs as objects, null keys omitted."""
    return F.to_json(F.struct(*[_portable(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
                                for f in df.schema.fields if not columns or f.name in columns]))


def _as_text(kind: T.DataType) -> T.DataType:
    if isinstance(kind, (T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    return kind


def _typed(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        made = F.struct(*[_typed(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), made)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _typed(x, kind.elementType))
    return c if _as_text(kind) == kind else c.try_cast(kind)


def entity_from_json(c, schema: T.StructType) -> Column:
    """JSON text as ``entity_json`` writes it -> struct of ``schema``: strings become decimals, dates and
    timestamps again, absent keys null; a value that is not of its type is null."""
    col = F.col(c) if isinstance(c, str) else c
    return _typed(F.from_json(col, _as_text(schema)), schema)
