"""File sources.

Every scan is a lazy Spark read with an explicit schema: award CSVs are read
all-string (codes such as ``015`` keep their zeros; types come later from
the cleaning rules), never with schema inference.
"""

from __future__ import annotations

import codecs
import csv
import io
import json
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import islice
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def string_schema(columns: Sequence[str], corrupt: bool = False) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in columns]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)


#: One task a file, so that a task may stop after a file's first line; rows go to Python singly, so that little more is read.
_HEADS = {"spark.sql.files.maxPartitionBytes": "1t", "spark.sql.files.openCostInBytes": "1t",
          "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
#: Files named in one row of the header scan's result.
_FILES_A_ROW = 1000


def _first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a task; what follows is not read."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def csv_headers(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8", sep: str = ",",
                quote: str = '"') -> dict[tuple[str, ...], list[str]]:
    """Header -> files that have it, for all files of a path, folder or glob (BOM removed).

    A Spark job of one task a file reads first lines, whatever store or compression Spark reads, and groups the files by
    line; the driver gets each file's path once, as Spark's own listing holds it, and a line only as often as its
    files fill rows of ``_FILES_A_ROW``. Files without any line are left out, and a path without a header line raises."""
    probe = spark.newSession()
    for k, v in _HEADS.items():
        probe.conf.set(k, v)
    text = probe.read.text(path)
    rows = len(text.inputFiles()) // _FILES_A_ROW + 1
    lines = text.where("_metadata.file_block_start = 0").select(
        F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"))
    found = (lines.mapInArrow(_first_row, "line binary, file string")
             .groupBy("line", F.pmod(F.xxhash64("file"), F.lit(rows))).agg(F.collect_list("file").alias("files")).collect())
    out: dict[tuple[str, ...], list[str]] = {}
    for r in found:
        # a cut character at the end (the line feed's other half in UTF-16) is no part of the line
        line = codecs.getincrementaldecoder(encoding)("replace").decode(bytes(r["line"])).lstrip("\ufeff")
        out.setdefault(tuple(next(csv.reader([line], delimiter=sep, quotechar=quote), ())), []).extend(map(unquote, r["files"]))
    if not out:
        raise ValueError(f"CSV at {path} has no header row")
    # in the order of the first file of each, as columns appear in it
    return {h: sorted(fs) for h, fs in sorted(out.items(), key=lambda kv: min(kv[1]))}


def csv_header(spark: SparkSession, path: str, encoding: str = "UTF-8", sep: str = ",", quote: str = '"') -> list[str]:
    """Columns of a CSV path: those of its headers, in the order they first appear."""
    return list(dict.fromkeys(c for h in csv_headers(spark, path, encoding, sep, quote) for c in h))


def scan_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, *,
             encoding: str = "UTF-8", sep: str = ",", quote: str = '"', flag_corrupt: bool = False,
             multi_line: bool = False) -> DataFrame:
    """CSV records by header, every column a string; ``""`` escapes quotes.

    Each file's cells go to the columns that its own header names; files with
    other headers are united by name (a column missing from a file is null
    there). ``columns`` chooses and orders the result's columns.
    ``flag_corrupt`` adds ``_corrupt_record`` for rows with more cells than
    the header (short rows are valid: missing cells read as null).
    ``multi_line`` allows newlines inside quoted cells; it makes each file one
    task, so it is off by default for large award extracts."""
    parts = [_scan_one_header(spark, files, header, encoding, sep, quote, flag_corrupt, multi_line)
             for header, files in csv_headers(spark, path, encoding, sep, quote).items()]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if columns is None:
        if flag_corrupt:
            columns = [c for c in out.columns if c != CORRUPT]
        else:
            return out
    have = set(out.columns)
    chosen = [F.col(f"`{c}`") if c in have else F.lit(None).cast("string").alias(c) for c in columns]
    return out.select(*chosen, *([CORRUPT] if flag_corrupt else []))


def _scan_one_header(spark, files, header, encoding, sep, quote, flag_corrupt, multi_line) -> DataFrame:
    cols = list(header)
    reader = (spark.read.option("header", True).option("encoding", encoding).option("sep", sep)
              .option("quote", quote).option("escape", quote).option("multiLine", multi_line)
              .option("mode", "PERMISSIVE"))
    if flag_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.schema(string_schema(cols, flag_corrupt)).csv(files)
    if flag_corrupt:
        # Spark flags short rows too; only a row with cells beyond the header
        # is malformed (short rows read their missing cells as null)
        wide = ", ".join([f"`c{i}` string" for i in range(len(cols))] + ["`__extra` string"])
        extra = F.from_csv(F.col(CORRUPT), wide, {"sep": sep, "quote": quote, "escape": quote})["__extra"]
        df = df.withColumn(CORRUPT, F.when(extra.isNotNull(), F.col(CORRUPT)))
    return df


def union_csv_parts(spark: SparkSession, paths: Sequence[str], **kw) -> DataFrame:
    """Scan each part by its own header and union all by column name
    (a column missing from a part is null there)."""
    return scan_csv(spark, list(paths), **kw)


def _listing_mark(spark: SparkSession, path: str) -> str:
    """Count and hash sum of the files' paths, lengths and times, from their listing; no content is read."""
    files = spark.read.format("binaryFile").load(path)
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    n, total = files.agg(F.count(F.lit(1)), F.sum(mark)).first()
    return f"{n}:{total}"


def jsonl_schema(spark: SparkSession, path: str, kept: str | None = None) -> T.StructType:
    """Schema of JSON lines from all lines, in one distributed pass; simple values are strings.

    ``kept``: a folder that keeps the schema with the state of the files it was read from. While they are the same, later
    runs take it from there and read no line; any new, lost or changed file means a pass over all lines again."""
    if kept is not None:
        mark = _listing_mark(spark, path)
        try:
            known = spark.read.schema("mark string, schema string").parquet(kept).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            known = None
        if known is not None and known["mark"] == mark:
            return T.StructType.fromJson(json.loads(known["schema"]))
        schema = jsonl_schema(spark, path)
        spark.createDataFrame([(mark, schema.json())], "mark string, schema string").coalesce(1).write.mode(
            "overwrite").parquet(kept)
        return schema
    schema = spark.read.option("primitivesAsString", True).option("mode", "DROPMALFORMED").json(path).schema
    if not schema.fields:
        raise ValueError(f"no records in {path}")
    return schema


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType, quarantine: bool = False) -> DataFrame:
    """JSON lines; a malformed line is dropped (or kept in
    ``_corrupt_record`` when ``quarantine``)."""
    reader = spark.read.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]")
    if quarantine:
        sch = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
        return reader.schema(sch).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT) \
            .json(path)
    return reader.schema(schema).option("mode", "DROPMALFORMED").json(path)


def parse_json_column(df: DataFrame, column: str, schema: T.StructType | str, alias: str = "parsed") -> DataFrame:
    """S4 on a column: JSON text -> struct (malformed -> null fields)."""
    return df.withColumn(alias, F.from_json(F.col(column), schema))


def scan_json_doc(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Whole-document JSON (one document per file, ``.gz`` read by
    suffix); a missing path raises."""
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def list_files(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """File listing (path, length, modification time) without reading contents."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
          .option("recursiveFileLookup", str(recursive).lower()).load(root))
    return df.select("path", "length", "modificationTime")


def file_fingerprint(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """Per file: size, SHA-256 and MD5 of the content (one task per file)."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
          .option("recursiveFileLookup", str(recursive).lower()).load(root))
    return df.select("path", "length", F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"))


ZIP_ROW_SCHEMA = "archive string, member string, row_no long, names array<string>, cells array<string>"
ZIP_ROWS = 10_000


def _unzip_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of the CSV members, streamed in runs of ZIP_ROWS."""
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as zf:
                for member in (m for m in zf.namelist() if not m.endswith("/")):
                    with io.TextIOWrapper(zf.open(member), "utf-8-sig", newline="") as text:
                        rows = csv.reader(text)
                        header, number = next(rows, None), 0
                        while header and (run := list(islice(rows, ZIP_ROWS))):
                            yield pd.DataFrame({
                                "archive": path, "member": member, "row_no": range(number + 1, number + len(run) + 1),
                                "names": [header] * len(run),
                                "cells": [(r + [None] * len(header))[:len(header)] for r in run]})
                            number += len(run)


def scan_zip_csv(spark: SparkSession, root: str, columns: Sequence[str] | None = None,
                 pattern: str = "*.zip") -> DataFrame:
    """CSV members of ZIP archives, without unpacking to local disk.

    Archives are read as binary files (one task each; a ZIP archive cannot be
    split, and one must fit Spark's 2 GB cell). Every member's cells go to
    the columns its own header names, all strings; a column missing from a member is
    null there."""
    arch = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(root).select("path", "content")
    rows = arch.mapInPandas(_unzip_rows, ZIP_ROW_SCHEMA)
    if columns is None:
        named = rows.select(F.explode("names").alias("name")).distinct().collect()  # column names
        columns = sorted(r["name"] for r in named)
        if not columns:
            raise ValueError("no CSV members found")
    by_name = F.map_from_arrays("names", "cells")
    return rows.select("archive", "member", "row_no", by_name.alias("_cells")).select(
        "archive", "member", "row_no", *[F.try_element_at("_cells", F.lit(c)).alias(c) for c in columns])


def newest_per_group(listing: DataFrame, group: str, order: str, keep: Sequence[str]) -> DataFrame:
    """The first entry per group by ``order`` (e.g. newest monthly file per
    fiscal year), by ``max_by`` aggregation; of equals the greatest in the kept columns' order."""
    payload = F.struct(*[F.col(c) for c in keep])
    best = F.max(F.struct(F.col(order).alias("o"), payload.alias("p")))
    return listing.groupBy(group).agg(best.alias("_b")).select(group, "_b.p.*")


# --- S20 / S21: dictionary and crosswalk -------------------------------------------------

# The columns of a data dictionary.
DICTIONARY_COLUMNS = ["field_name", "type", "description", "required", "is_key", "groups", "validation_rules"]


def load_dictionary_csv(spark: SparkSession, path: str) -> DataFrame:
    """Data dictionary CSV ``field_name, type, description, required, is_key, groups,
    validation_rules`` (columns it lacks are null); ``required``/``is_key`` are true when the text is true, ``groups`` and
    ``validation_rules`` are comma lists."""
    d = scan_csv(spark, path, DICTIONARY_COLUMNS)
    return d.select(F.trim("field_name").alias("field_name"), F.trim("type").alias("type"), "description",
                    (F.lower(F.trim("required")) == "true").alias("required"),
                    (F.lower(F.trim("is_key")) == "true").alias("is_key"),
                    split_list_cell("groups").alias("groups"), split_list_cell("validation_rules").alias("validation_rules"))


def merge_dictionary(configured: DataFrame, csv_dict: DataFrame) -> DataFrame:
    """CSV entries override and extend configured field properties by name.

    Columns that only one side has (``description``, ``groups``, ``validation_rules``) are kept."""
    extra = [x for x in ("description", "groups", "validation_rules") if x in csv_dict.columns or x in configured.columns]

    def full(df):
        return df.select("field_name", "type", "required", "is_key",
                         *[x if x in df.columns else F.lit(None).alias(x) for x in extra])

    c = full(configured).alias("c")
    d = full(csv_dict).alias("d")
    j = c.join(d, F.col("c.field_name") == F.col("d.field_name"), "full_outer")
    return j.select(F.coalesce("d.field_name", "c.field_name").alias("field_name"),
                    F.coalesce("d.type", "c.type").alias("type"),
                    F.coalesce("d.required", "c.required", F.lit(False)).alias("required"),
                    F.coalesce("d.is_key", "c.is_key", F.lit(False)).alias("is_key"),
                    *[F.coalesce(f"d.{x}", f"c.{x}").alias(x) for x in extra],
                    F.when(F.col("d.field_name").isNotNull(), F.lit("csv")).otherwise(F.lit("config"))
                    .alias("source"))


# Crosswalk required columns, list columns and allowed groupings.
CROSSWALK_REQUIRED = ["Element", "Definition", "FPDS Data Dictionary Element", "Grouping", "Domain Values",
                      "Domain Values Code Description"]
CROSSWALK_ALLOWED_GROUPINGS = ["Award Attribute", "Award Spending", "Recipient Attribute", "Contract Attribute",
                               "Location Attribute"]


def split_list_cell(c) -> F.Column:
    """List cell split on comma and newline, items trimmed, empties dropped."""
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.transform(F.split(F.coalesce(col, F.lit("")), "[,\n]"), lambda x: F.trim(x)),
                    lambda x: x != "")


def scan_crosswalk(spark: SparkSession, path: str, list_columns: Sequence[str] = ("Domain Values",)) -> DataFrame:
    """Crosswalk CSV (quoted multi-line cells kept), required columns
    checked, list cells split on comma and newline."""
    cols = csv_header(spark, path)
    missing = [c for c in CROSSWALK_REQUIRED if c not in cols]
    if missing:
        raise ValueError(f"crosswalk is missing required columns: {missing}")
    df = scan_csv(spark, path, cols, multi_line=True)
    return df.withColumns({c: split_list_cell(c) for c in list_columns if c in cols})


def validate_crosswalk(df: DataFrame) -> DataFrame:
    """S21 row rules: element pattern, non-empty definition, allowed grouping,
    every domain value matching the item pattern. Adds ``problems`` (text list)."""
    checks = [
        (~F.coalesce(F.col("Element").rlike("^[A-Za-z0-9_]+$"), F.lit(False)), "element_format"),
        (F.coalesce(F.length(F.trim("Definition")), F.lit(0)) < 1, "definition_empty"),
        (~F.coalesce(F.col("Grouping").isin(CROSSWALK_ALLOWED_GROUPINGS), F.lit(False)), "grouping_not_allowed"),
        (~F.forall("Domain Values", lambda x: x.rlike("^[A-Za-z0-9_]+$")), "domain_value_format"),
    ]
    probs = F.filter(F.array(*[F.when(cond, F.lit(name)) for cond, name in checks]), lambda x: x.isNotNull())
    return df.withColumn("problems", probs)


def select_crosswalk(df: DataFrame, wanted: dict[str, dict]) -> DataFrame:
    """The crosswalk entry of each wanted field, ``{field: {"element": ..., "grouping": ...}}``: rows (field, then the
    crosswalk's columns); a field without an entry is left out."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(w["element"]).alias("e"), F.lit(w["grouping"]).alias("g"))
                      for f, w in wanted.items()])
    hit = F.filter(pairs, lambda p: (p["e"] == F.col("Element")) & (p["g"] == F.col("Grouping")))
    return df.select(F.explode(hit).alias("_p"), "*").select(F.col("_p.field").alias("field"), *df.columns)


def group_crosswalk(df: DataFrame, entities: dict[str, list[dict]]) -> DataFrame:
    """Crosswalk entries by entity, ``{entity: [{"grouping": ..., "elements": [...]}]}``: rows (entity, then the
    crosswalk's columns) of the entries that an entity's grouping lists."""
    lists = F.array(*[F.struct(F.lit(e).alias("entity"), F.lit(g["grouping"]).alias("g"), F.lit(x).alias("e"))
                      for e, groups in entities.items() for g in groups for x in g["elements"]])
    hit = F.filter(lists, lambda p: (p["e"] == F.col("Element")) & (p["g"] == F.col("Grouping")))
    return df.select(F.explode(hit).alias("_p"), "*").select(F.col("_p.entity").alias("entity"), *df.columns)
