"""Benchmark the headline queries; prints ONE JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPEATS (default 3). Each query is run warm, its result
written to Spark's ``noop`` sink (the full plan executes, nothing is
collected), and the median wall time is reported.
"""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from fedlake.operators import summary  # noqa: E402
from fedlake.operators import validate as V  # noqa: E402
from fedlake.operators.derive import transform_rules  # noqa: E402
from fedlake.plans import entity_queries, summary_queries  # noqa: E402
from fedlake.plans.award import VIEWS, award_narrow, view_columns  # noqa: E402
from fedlake.session import get_spark, load, scratch_path  # noqa: E402
from fedlake.sources import store  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

LINEITEM_RULES = [
    {"field": "l_quantity", "ops": [{"type": "round", "ndigits": 0, "min_value": 0}]},
    {"field": "l_returnflag", "ops": [{"type": "trim"}, {"type": "uppercase"}]},
    {"field": "l_linestatus", "ops": [{"type": "trim"}, {"type": "uppercase"}, {"type": "decode",
                                                                              "table": "yes_no_extended"}]},
    {"field": "l_extendedprice", "ops": [{"type": "convert_to_decimal"}]},
    {"field": "l_shipdate", "ops": [{"type": "derive_fiscal_year"}]},
]
LINEITEM_CHECKS = [
    {"field": "l_quantity", "type": "range", "params": {"min": 1, "max": 50}},
    {"field": "l_discount", "type": "range", "params": {"min": 0, "max": 0.1}},
    {"field": "l_returnflag", "type": "enum", "params": {"values": ["A", "N", "R"]}},
    {"field": "l_linestatus", "type": "required", "severity": "warning"},
    {"field": "l_extendedprice", "type": "precision", "params": {"max_places": 2}},
    {"field": "l_discount", "type": "compare", "params": {"operator": "<=", "compare_to": "l_tax"},
     "severity": "info"},
    {"field": "l_orderkey", "type": "required"},
    {"field": "l_shipdate", "type": "range", "params": {"min": 1990, "max": 2100}},
]


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats=REPEATS):
    times = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    spark = get_spark(f"local[{CPUS}]", CPUS)
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    rows = {t: load(spark, SF_DIR, t).count() for t in ("orders", "lineitem")}

    def q_latest_orders():
        noop(summary_queries.flagship(spark, SF_DIR))

    def q_latest_lineitem():
        noop(summary_queries.latest_by_part(spark, SF_DIR))

    narrow_cols = list(dict.fromkeys(c for _, g, e in VIEWS for c in view_columns(g, e)))
    narrow_paths = []

    def q_narrow_build():
        # the shared input of the views: lineitem + 6 dimension joins, written once
        path = scratch_path(spark, "bench-narrow")
        award_narrow(spark, SF_DIR, narrow_cols).write.parquet(path)
        narrow_paths.append(path)

    def q_eight_views():
        narrow = spark.read.parquet(narrow_paths[-1])
        views = summary.latest_by_group_many(narrow, [(g, e) for _, g, e in VIEWS])
        with ThreadPoolExecutor(4) as pool:  # independent view jobs submitted together
            list(pool.map(noop, views))

    def q_clean_validate():
        li = load(spark, SF_DIR, "lineitem")
        cleaned = transform_rules(li, LINEITEM_RULES)
        checked = V.validate(cleaned, LINEITEM_CHECKS)
        noop(checked.select("l_orderkey", "l_linenumber", V.is_valid().alias("ok"), F.size("violations")))

    def q_agency_roles():
        noop(entity_queries.q_rel_contract_agency_roles(spark, SF_DIR))

    def q_store_write():
        o = load(spark, SF_DIR, "orders")
        store.write_entities(store.to_store_rows(o, "contract"), scratch_path(spark, "bench-store"))

    plan = {
        "latest_by_group_orders": q_latest_orders,
        "latest_by_group_lineitem": q_latest_lineitem,
        "narrow_table_build": q_narrow_build,
        "eight_views": q_eight_views,
        "clean_validate_lineitem": q_clean_validate,
        "agency_roles_join": q_agency_roles,
        "store_write_orders": q_store_write,
    }
    q_latest_orders()  # warm-up: JVM, codegen caches, file listing
    results = {name: round(timed(fn), 3) for name, fn in plan.items()}
    extra = {
        "clean_validate_rows_per_sec": round(rows["lineitem"] / results["clean_validate_lineitem"]),
        "store_write_rows_per_sec": round(rows["orders"] / results["store_write_orders"]),
        "latest_orders_rows_per_sec": round(rows["orders"] / results["latest_by_group_orders"]),
    }
    out = {"metric": "headline_total", "value": round(sum(results.values()), 3), "unit": "sec",
           "queries": results, "sf": float(sf.group(1)) if sf else None, "cpus": CPUS, "repeats": REPEATS,
           "rows": rows, "throughput": extra}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
