"""File source and sink queries.

Each query first writes the test table it needs as files (the stand-in
input) into a fresh folder under the shared checkpoint dir, then runs the
library's reader on them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import fiscal_year
from ..operators import metrics, summary
from ..session import load, materialize, path_bytes, scratch_path, slices_for
from ..sources import files, sinks
from .award import VIEWS, award_narrow, award_narrow_sql, award_slices, view_columns
from .catalog import register
from .summary_queries import VIEW_FIELDS_ORDER, latest_sql


@register("scan_csv",
          "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
          "CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer")
def q_scan_csv(spark, sf_dir):
    """S1 + S3: customers written as CSV, scanned back by header, all columns text."""
    path = scratch_path(spark, "customer-csv")
    sinks.write_csv(load(spark, sf_dir, "customer"), path)
    return files.scan_csv(spark, path)


_PARTS = {"F": ["o_orderkey", "o_custkey", "o_orderstatus"],
          "O": ["o_orderkey", "o_orderstatus", "o_orderpriority"],
          "P": ["o_orderkey", "o_orderstatus", "o_orderdate"]}


def _part_sql(status, cols):
    sel = []
    for c in cols:
        if c == "o_orderdate":
            sel.append("strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate")
        else:
            sel.append(f"CAST({c} AS VARCHAR) AS {c}")
    return f"SELECT {', '.join(sel)} FROM orders WHERE {_part_condition(status)}"


def _part_condition(status):
    """Rows of a part: its status; the last part takes every status that the others do not name, null included."""
    *named, last = _PARTS
    if status != last:
        return f"o_orderstatus = '{status}'"
    listed = ", ".join(f"'{s}'" for s in named)
    return f"o_orderstatus IS NULL OR o_orderstatus NOT IN ({listed})"


@register("union_csv_parts", " UNION ALL BY NAME ".join(_part_sql(s, c) for s, c in _PARTS.items()))
def q_union_csv_parts(spark, sf_dir):
    """S2 + U1: three CSV extracts with different columns, each scanned by its
    own header and unioned by name."""
    o = load(spark, sf_dir, "orders")
    paths = []
    for status, cols in _PARTS.items():
        p = scratch_path(spark, f"orders-{status}")
        sinks.write_csv(o.where(_part_condition(status)).select(*cols), p)
        paths.append(p)
    return files.union_csv_parts(spark, paths)


@register("parse_json_props",
          "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def q_parse_json_props(spark, sf_dir):
    """The JSON payload column parsed with an explicit schema."""
    e = load(spark, sf_dir, "events")
    return files.parse_json_column(e, "props", "k long").select("event_id", "parsed.k")


EVENT_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                             T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                             T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


@register("scan_jsonl", "SELECT * FROM events")
def q_scan_jsonl(spark, sf_dir):
    """S4 + S6: events written as gzip JSON lines, scanned back with a schema
    (malformed lines would be dropped)."""
    path = scratch_path(spark, "events-jsonl")
    sinks.write_json(load(spark, sf_dir, "events"), path, compress=True)
    return files.scan_jsonl(spark, path, EVENT_SCHEMA)


@register("scan_csv_mixed_headers",
          "SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CAST(o_custkey AS VARCHAR) AS customer_key, o_orderstatus AS status, "
          "CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS priority FROM orders")
def q_scan_csv_mixed_headers(spark, sf_dir):
    """One folder of CSVs whose headers differ in order and columns, and a file set with another separator and quote;
    every cell under the column its own header names."""
    o = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_key"), F.col("o_custkey").cast("string").alias("customer_key"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), (F.col("o_orderkey") % 3).alias("_k"))
    path = scratch_path(spark, "orders-mixed-csv")
    layouts = [["order_key", "customer_key", "status"], ["status", "priority", "order_key", "customer_key"],
               ["customer_key", "status", "order_key"]]
    for k, cols in enumerate(layouts):
        w = o.where(F.coalesce("_k", F.lit(0)) == k).select(*cols).write.option("header", True)
        if k == 2:
            w = w.option("sep", ";").option("quote", "'").option("quoteAll", True)
        w.csv(f"{path}/{'other' if k == 2 else 'main'}/part{k}")
    main = files.scan_csv(spark, f"{path}/main/*")
    other = files.scan_csv(spark, f"{path}/other/*", sep=";", quote="'")
    return main.unionByName(other, allowMissingColumns=True).select("order_key", "customer_key", "status", "priority")


@register("export_views",
          " UNION ALL ".join(
              f"SELECT '{k}' AS view, CAST(count(*) AS BIGINT) AS n FROM ("
              + latest_sql(award_narrow_sql(view_columns(g, e)), g, "last_modified_date",
                           "potential_total_value_of_award",
                           [g] + VIEW_FIELDS_ORDER + [x for x in e if x not in VIEW_FIELDS_ORDER and x != g]) + ")"
              for k, g, e in VIEWS))
def q_export_views(spark, sf_dir):
    """The eight views written as one folder each from a narrow table
    materialised once; row counts read back per view."""
    cols = list(dict.fromkeys(c for _, g, e in VIEWS for c in view_columns(g, e)))
    narrow_path = scratch_path(spark, "narrow")
    narrow, _ = materialize(award_slices(spark, sf_dir, cols), "narrow", path=narrow_path, compression="zstd")
    reports = summary.latest_by_group_many(narrow, [(g, e) for _, g, e in VIEWS],
                                           slices=slices_for(path_bytes(spark, narrow_path)))
    views = {k: r for (k, _, _), r in zip(VIEWS, reports)}
    root = scratch_path(spark, "views")
    paths = sinks.export_views(views, root)
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("view"), "n")
             for k, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_FIELDS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register("entity_csv_roundtrip",
          "SELECT concat_ws(',', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), "
          "CAST(c_acctbal AS VARCHAR), c_mktsegment) AS line, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, "
          "CAST(c_acctbal AS VARCHAR) AS c_acctbal FROM customer")
def q_entity_csv_roundtrip(spark, sf_dir):
    """Entity rows to CSV text in a fixed field order and back."""
    c = load(spark, sf_dir, "customer")
    lines = c.select(sinks.entity_csv_line(_FIELDS).alias("line"))
    back = lines.select("line", sinks.entity_from_csv_line("line", _FIELDS).alias("e"))
    return back.select("line", "e.c_custkey", "e.c_name", "e.c_acctbal")


@register("entity_to_json",
          "SELECT '{\"award_id_piid\":' || CAST(l_orderkey AS VARCHAR) || ',\"federal_action_obligation\":\"' || "
          "CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,2)) "
          "AS VARCHAR) || '\",\"last_modified_date\":\"' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '\"}' AS json "
          "FROM lineitem")
def q_entity_to_json(spark, sf_dir):
    """Entity rows to JSON (decimals as text, timestamps ISO)."""
    t = award_narrow(spark, sf_dir, ["award_id_piid", "federal_action_obligation", "last_modified_date"])
    return t.select(sinks.entity_json(t).alias("json"))


_DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
_LABEL_COLS = ["doc_id", "quality", "toxic"]


def _profile_sql():
    parts = []
    for c in _DOC_COLS:
        parts.append(f"SELECT '{c}' AS field_name, count(*) = count({c}) AS required, "
                     f"count(DISTINCT {c}) = count(*) AS is_key FROM documents")
    return " UNION ALL ".join(parts)


_CFG_SQL = ("SELECT * FROM (VALUES ('doc_id', 'bigint'), ('text', 'string'), ('lang', 'string'), "
            "('source', 'string'), ('n_chars', 'bigint'), ('quality', 'int'), ('toxic', 'int')) v(field_name, type)")


@register("dictionary_merge",
          f"SELECT coalesce(p.field_name, c.field_name) AS field_name, c.type AS type, "
          f"coalesce(p.required, false) AS required, coalesce(p.is_key, false) AS is_key, "
          f"CASE WHEN p.field_name IS NOT NULL THEN 'column ' || p.field_name END AS description, "
          f"CASE WHEN p.field_name IS NOT NULL THEN 'profile|' || c.type END AS groups, "
          f"CASE WHEN p.field_name IS NOT NULL THEN 'max_length' END AS validation_rules, "
          f"CASE WHEN p.field_name IS NOT NULL THEN 'csv' ELSE 'config' END AS source "
          f"FROM ({_CFG_SQL}) c FULL OUTER JOIN ({_profile_sql()}) p ON c.field_name = p.field_name")
def q_dictionary_merge(spark, sf_dir):
    """A data dictionary CSV profiled from ``documents`` (required = no
    nulls, key = all distinct) overrides the configured properties of the
    ``documents``/``labels`` fields; configured-only fields stay. Distinct values are
    counted by 64-bit hash, one column at a time, so no text is shuffled but what repeats a hash."""
    d = load(spark, sf_dir, "documents")
    lab = load(spark, sf_dir, "labels")
    # configured properties: the tables' own schemas (driver metadata)
    cfg_rows = [(f.name, f.dataType.simpleString(), False, False) for f in d.schema.fields] + \
        [(f.name, f.dataType.simpleString(), False, False) for f in lab.schema.fields if f.name != "doc_id"]
    configured = spark.createDataFrame(cfg_rows, "field_name string, type string, required boolean, is_key boolean")
    profiles = []
    for c, kind in d.dtypes:
        prof = d.select(F.col(c).isNotNull().alias("filled"), F.xxhash64(c).alias("h")).groupBy("filled", "h").agg(
            F.count(F.lit(1)).alias("n")).agg(
            F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("filled"), F.col("n"))), F.lit(0)).alias("filled"))
        profiles.append(prof.select(
            F.lit(c).alias("field_name"), F.lit(None).cast("string").alias("type"), F.lit(f"column {c}").alias("description"),
            F.when(F.col("filled") == F.col("rows"), "true").otherwise("false").alias("required"),
            F.lit(str(metrics.is_key(d, c)).lower()).alias("is_key"),
            F.lit(f"profile, {kind}").alias("groups"), F.lit("max_length,").alias("validation_rules")))
    rows = reduce(lambda a, b: a.unionByName(b), profiles)
    path = scratch_path(spark, "dictionary-csv")
    sinks.write_csv(rows, path)
    merged = files.merge_dictionary(configured, files.load_dictionary_csv(spark, path))
    return merged.withColumns({c: F.array_join(c, "|") for c in ("groups", "validation_rules")})


_XW_SQL = (
    "SELECT replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS VARCHAR) AS Element, "
    "CASE WHEN p_size % 9 = 0 THEN ' ' ELSE p_type || chr(10) || p_brand END AS Definition, "
    "CASE p_size % 6 WHEN 0 THEN 'Award Attribute' WHEN 1 THEN 'Award Spending' WHEN 2 THEN 'Recipient Attribute' "
    "WHEN 3 THEN 'Contract Attribute' WHEN 4 THEN 'Location Attribute' ELSE 'Other' END AS Grouping, "
    "p_type || ', ' || CASE WHEN p_size % 5 = 0 THEN p_brand ELSE replace(p_brand, '#', '_') END || chr(10) || 'S' || "
    "CAST(p_size AS VARCHAR) || ',' AS dv FROM part")
_XW_SPLIT = "list_filter(list_transform(string_split_regex(dv, '[,\\n]'), lambda x: trim(x)), lambda x: x <> '')"


def _crosswalk(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    xw = p.select(
        F.concat(F.regexp_replace("p_name", " ", "_"), F.lit("_"), F.col("p_partkey").cast("string")).alias("Element"),
        F.when(F.col("p_size") % 9 == 0, F.lit(" ")).otherwise(F.concat("p_type", F.lit("\n"), "p_brand"))
        .alias("Definition"),
        F.upper(F.regexp_replace("p_brand", "#", "")).alias("FPDS Data Dictionary Element"),
        F.element_at(F.array(*[F.lit(g) for g in files.CROSSWALK_ALLOWED_GROUPINGS] + [F.lit("Other")]),
                     (F.col("p_size") % 6 + 1).cast("int")).alias("Grouping"),
        F.concat("p_type", F.lit(", "), F.when(F.col("p_size") % 5 == 0, F.col("p_brand"))
                 .otherwise(F.regexp_replace("p_brand", "#", "_")), F.lit("\nS"), F.col("p_size").cast("string"),
                 F.lit(",")).alias("Domain Values"),
        F.col("p_name").alias("Domain Values Code Description"))
    path = scratch_path(spark, "crosswalk-csv")
    sinks.write_csv(xw, path)
    return files.scan_crosswalk(spark, path)


@register("crosswalk_split",
          f"SELECT Element, Definition, CAST(len({_XW_SPLIT}) AS INTEGER) AS n_values, array_to_string({_XW_SPLIT}, '|') AS domain_values "
          f"FROM ({_XW_SQL})")
def q_crosswalk_split(spark, sf_dir):
    """Crosswalk read with multi-line definitions kept and list cells split
    on comma and newline."""
    xw = _crosswalk(spark, sf_dir)
    return xw.select("Element", "Definition", F.size("Domain Values").alias("n_values"),
                     F.array_join("Domain Values", "|").alias("domain_values"))


@register("crosswalk_validate",
          f"SELECT Element, concat_ws(',', CASE WHEN NOT regexp_matches(Element, '^[A-Za-z0-9_]+$') THEN "
          "'element_format' END, CASE WHEN length(trim(Definition)) < 1 THEN 'definition_empty' END, "
          "CASE WHEN Grouping NOT IN ('Award Attribute', 'Award Spending', 'Recipient Attribute', 'Contract Attribute', "
          "'Location Attribute') THEN 'grouping_not_allowed' END, CASE WHEN NOT list_bool_and(list_transform("
          f"{_XW_SPLIT}, lambda x: regexp_matches(x, '^[A-Za-z0-9_]+$'))) THEN 'domain_value_format' END) AS problems "
          f"FROM ({_XW_SQL})")
def q_crosswalk_validate(spark, sf_dir):
    """Crosswalk row rules (element format, definition present, allowed
    grouping, every domain value well-formed)."""
    v = files.validate_crosswalk(_crosswalk(spark, sf_dir))
    return v.select("Element", F.array_join("problems", ",").alias("problems"))


@register("first_file_per_year",
          "WITH l AS (SELECT DISTINCT CAST(year(CAST(l_shipdate AS DATE) + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_year, "
          "CAST((month(l_shipdate) + 2) % 12 + 1 AS INTEGER) AS period FROM lineitem WHERE l_shipdate IS NOT NULL) "
          "SELECT fiscal_year, printf('FY%d_P%02d_Contracts_Full.zip', fiscal_year, max(period)) AS file_name, "
          "max(period) AS period FROM l GROUP BY fiscal_year")
def q_first_file_per_year(spark, sf_dir):
    """Newest monthly extract per fiscal year from a file listing (the
    listing is derived from the ship dates present)."""
    li = load(spark, sf_dir, "lineitem").where(F.col("l_shipdate").isNotNull())
    listing = li.select(fiscal_year("l_shipdate").alias("fiscal_year"),
                        ((F.month("l_shipdate") + 2) % 12 + 1).cast("int").alias("period")).distinct()
    listing = listing.withColumn("file_name", F.format_string("FY%d_P%02d_Contracts_Full.zip", "fiscal_year",
                                                              "period"))
    return files.newest_per_group(listing, "fiscal_year", "period", ["file_name", "period"])


@register("write_csv",
          "SELECT concat_ws(',', CAST(o_orderkey AS VARCHAR), o_orderstatus, CAST(o_totalprice AS VARCHAR), "
          "o_orderpriority) AS line FROM orders")
def q_write_csv(spark, sf_dir):
    """S3: CSV written with a fixed field list; the written text read back line
    by line (header lines excluded)."""
    path = scratch_path(spark, "orders-csv-text")
    fields = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    sinks.write_csv(load(spark, sf_dir, "orders"), path, fields)
    lines = spark.read.text(path)
    return lines.where(F.col("value") != ",".join(fields)).select(F.col("value").alias("line"))


@register("scan_json_doc",
          "SELECT r.r_regionkey AS region_key, r.r_name AS region_name, CAST(count(*) AS BIGINT) AS n_nations, "
          "string_agg(n.n_name, ',' ORDER BY n.n_nationkey) AS nations FROM region r JOIN nation n "
          "ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2")
def q_scan_json_doc(spark, sf_dir):
    """One JSON document per file (a region with its nations, gzip), read
    back whole-document."""
    from ..operators.relations import chunked_collect
    r = load(spark, sf_dir, "region")
    n = load(spark, sf_dir, "nation")
    from ..operators.joins import join_small
    pairs = join_small(n, r, n.n_regionkey == r.r_regionkey, "inner").select(
        F.col("r_regionkey").alias("region_key"), F.col("r_name").alias("region_name"), "n_nationkey", "n_name")
    docs = chunked_collect(pairs, ["region_key", "region_name"],
                           F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")), "n_nationkey",
                           alias="nations")
    path = scratch_path(spark, "region-docs")
    (docs.select("region_key", "chunk", F.to_json(F.struct("region_key", "region_name", "nations")).alias("doc"))
     .repartition("region_key", "chunk").write.partitionBy("region_key", "chunk").option("compression", "gzip")
     .text(path))
    back = files.scan_json_doc(spark, path, T.StructType([
        T.StructField("region_key", T.IntegerType()), T.StructField("region_name", T.StringType()),
        T.StructField("nations", T.ArrayType(T.StructType([T.StructField("key", T.IntegerType()),
                                                            T.StructField("name", T.StringType())])))]))
    return back.select("region_key", "region_name", F.size("nations").cast("bigint").alias("n_nations"),
                       F.array_join(F.transform("nations", lambda x: x["name"]), ",").alias("nations"))


@register("write_json",
          "SELECT '{\"o_orderkey\":' || CAST(o_orderkey AS VARCHAR) || ',\"o_custkey\":' || CAST(o_custkey AS VARCHAR) "
          "|| ',\"o_orderstatus\":\"' || o_orderstatus || '\",\"o_totalprice\":' || CAST(o_totalprice AS VARCHAR) || "
          "',\"o_orderdate\":\"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '\",\"o_orderpriority\":\"' || "
          "o_orderpriority || '\"}' AS line FROM orders")
def q_write_json(spark, sf_dir):
    """Orders written as gzip JSON lines (timestamps with microseconds);
    the written text read back line by line."""
    path = scratch_path(spark, "orders-json-text")
    sinks.write_json(load(spark, sf_dir, "orders"), path, compress=True)
    return spark.read.text(path).select(F.col("value").alias("line"))
