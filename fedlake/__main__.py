"""Command line: ``python -m fedlake convert|views ...``.

``convert``  award records (CSV / JSON lines / Parquet) -> cleaned, checked,
             mapped entities upserted into an entity store.
``views``    award records -> the eight latest-per-group views, one folder each.

Both run on whatever master ``spark-submit`` or the environment provides.
"""

from __future__ import annotations

import argparse
import sys


def _read(spark, path: str, fmt: str, schema: str | None = None):
    from .sources import files

    if fmt == "csv":
        return files.scan_csv(spark, path)
    if fmt == "jsonl":
        return files.scan_jsonl(spark, path, files.jsonl_schema(spark, path, kept=schema))
    return spark.read.parquet(path)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="fedlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("convert", help="records -> entity store")
    c.add_argument("--input", required=True)
    c.add_argument("--format", choices=["csv", "jsonl", "parquet"], default="csv")
    c.add_argument("--config", help="YAML/JSON config with field_properties (and optionally entities)")
    c.add_argument("--store", required=True, help="entity store root")
    c.add_argument("--as-of", help="as-of date for not-in-the-future checks (yyyy-MM-dd)")
    c.add_argument("--on-error", choices=["abort", "skip", "log"], help="error policy of all entities (default: each entity's own)")
    c.add_argument("--max-errors", type=int, help="invalid records that abort tolerates per entity (default: the entity's, else 0)")
    c.add_argument("--quarantine", help="folder for invalid records, replaced")
    v = sub.add_parser("views", help="records -> eight latest-per-group views")
    v.add_argument("--input", required=True)
    v.add_argument("--format", choices=["csv", "jsonl", "parquet"], default="csv")
    v.add_argument("--output", required=True)
    v.add_argument("--fields", help="report columns after the key, comma-separated (default: the usual ones the input has)")
    v.add_argument("--output-format", choices=["parquet", "csv"], default="parquet")
    for command in (c, v):
        command.add_argument("--schema", help="folder that keeps the schema of JSON lines, used again while the files are the same")
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from .session import get_spark, materialize, path_bytes, scratch_path, slices_for
    owned = SparkSession.getActiveSession() is None
    spark = get_spark()
    records = _read(spark, args.input, args.format, args.schema)
    if args.cmd == "convert":
        from . import spec
        from .plans.conversion import convert
        from .plans.entities import ENTITIES
        config = spec.load_config(args.config) if args.config else None
        entities = (config or {}).get("entities") or ENTITIES
        convert(spark, records, entities, config=config, as_of=args.as_of, store_root=args.store, on_error=args.on_error,
                max_errors=args.max_errors, quarantine=args.quarantine)
        from .sources.store import count_entities
        for r in count_entities(spark, args.store).collect():
            print(f"{r['entity_type']}: {r['n']}")
    else:
        from .functions.numbers import money_parse
        from .functions.dates import date_parse_multi
        from .operators.summary import latest_by_group_many
        from .plans.award import VIEWS
        from .sources.sinks import export_views
        typed = records
        if dict(records.dtypes).get("potential_total_value_of_award") == "string":
            typed = typed.withColumn("potential_total_value_of_award", money_parse("potential_total_value_of_award"))
        if dict(records.dtypes).get("last_modified_date") == "string":
            typed = typed.withColumn("last_modified_date",
                                     date_parse_multi("last_modified_date", ("%Y-%m-%d", "%m/%d/%Y", "%Y%m%d")))
        # the parsed records are written once; every view reads its few columns of them
        path = scratch_path(spark, "view-records")
        typed, _ = materialize(typed, "view-records", path=path, compression="zstd")
        reports = latest_by_group_many(typed, [(g, e) for _, g, e in VIEWS], fields=args.fields and args.fields.split(","),
                                       slices=slices_for(path_bytes(spark, path)))
        names = ["award", "recipient", "parent", "psc", "awarding_subagency", "awarding_office",
                 "funding_subagency", "funding_office"]
        for name, path in export_views(dict(zip(names, reports)), args.output, args.output_format).items():
            print(f"{name}: {path}")
    if owned:  # leave a caller's session running
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
