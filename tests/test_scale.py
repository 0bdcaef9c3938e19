"""Hot keys and pushdown: plan properties that matter at scale."""

from pyspark.sql import functions as F

from fedlake.operators import relations, summary
from fedlake.plans.award import award_narrow
from fedlake.session import scratch_path
from fedlake.sources import store
from tests.conftest import SMOKE


def _skewed(spark):
    # a third of all rows share one group key
    return spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("g"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("day"),
        F.col("id").cast("double").alias("v"), F.col("id"))


def test_latest_records_hot_key_matches_brute_force(spark):
    df = _skewed(spark)
    got = sorted((r.g, r.id, r.row_count) for r in summary.latest_records(df, "g", "day").collect())
    pdf = df.toPandas()
    pdf = pdf[pdf.g.notna()]
    want = []
    for g, grp in pdf.groupby("g"):
        days = grp.day.dropna()
        top = grp[grp.day == days.max()] if len(days) else grp[grp.day.isna()]
        want += [(g, int(i), len(top)) for i in top.id]
    assert got == sorted(want)


def test_hot_key_plan_aggregates_before_shuffle(spark):
    plan = summary.latest_records(_skewed(spark), "g", "day")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    # the per-group table comes from a written table, joined by broadcast
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_chunked_collect_hot_parent_rows_bounded(spark):
    out = relations.chunked_collect(_skewed(spark), ["g"], F.col("id"), "id", chunk_size=2000)
    sizes = {r.g: [] for r in out.select("g").distinct().collect()}
    for r in out.select("g", "n_items").collect():
        sizes[r.g].append(r.n_items)
    assert sum(sizes["hot"]) == 10000 and len(sizes["hot"]) == 5
    assert max(sizes["hot"]) < 3000


def test_narrow_scan_reads_only_needed_columns(spark):
    df = award_narrow(spark, SMOKE, ["award_id_piid", "last_modified_date"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in plan
    assert "orders.parquet" not in plan     # no dimension join when no dimension column is asked for


def test_entity_get_prunes_partitions(spark):
    root = scratch_path(spark, "t-prune")
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    store.write_entities(store.to_store_rows(rows, "thing"), root)
    plan = store.get_entity(spark, root, "thing", "x" * 64)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(entity_type" in plan and "shard" in plan.split("PartitionFilters")[1]


def test_joins_are_sized_by_bytes(spark):
    from fedlake.operators.joins import join_small
    big = spark.range(1_000_000).withColumnRenamed("id", "k")
    wide = spark.range(5000).select(F.col("id").alias("j"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 80).alias("text"))
    joined = join_small(big, wide, F.col("k") == F.col("j"), materialize=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    assert "Broadcast" not in plan and "SinglePartition" not in plan


def test_chunks_keep_the_order_of_a_repeated_key(spark):
    df = spark.range(5000).select(F.lit("p").alias("p"), (F.col("id") % 3).alias("k"), "id")
    rows = relations.chunked_collect(df, ["p"], F.col("k"), "k", chunk_size=1000).orderBy("chunk").collect()
    assert [r.n_items for r in rows] == [1000] * 5
    flat = [x for r in rows for x in r["items"]]
    assert flat == sorted(flat)


def test_unchanged_batch_writes_nothing(spark):
    root = scratch_path(spark, "t-append")
    rows = spark.createDataFrame([(str(i),) for i in range(50)], "v string")
    assert store.upsert(spark, store.to_store_rows(rows, "thing"), root) == 50
    before = sorted(spark.read.parquet(root).inputFiles())
    assert store.upsert(spark, store.to_store_rows(rows, "thing"), root) == 0
    assert sorted(spark.read.parquet(root).inputFiles()) == before
    more = spark.createDataFrame([("new",)], "v string")
    assert store.upsert(spark, store.to_store_rows(more, "thing"), root) == 1
    assert set(before) < set(spark.read.parquet(root).inputFiles())


def _entity(order=()):
    return {"key_fields": ["k"], "order_by": list(order), "field_mappings": {"direct": {"k": "k", "v": "v", "w": "w"}}}


def test_extraction_never_sorts_raw_rows(spark):
    from fedlake.operators import mapping
    path = scratch_path(spark, "t-extract")
    # one key holds a third of the rows; dates tie, and may all be null
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.when(F.col("id") % 50 != 7, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int"))).alias("d"),
        (F.col("id") % 11).alias("m"), F.col("id").cast("string").alias("v"), (F.col("id") % 5).alias("w"))
    rows.write.parquet(path)
    t = spark.read.parquet(path)
    got = mapping.extract_entity(t, _entity(["d", "m"]), order_by=["d", "m"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortAggregate") < plan.index("Join") < plan.index("HashAggregate")
    best = {}
    for r in t.collect():
        order = (r.d is not None, r.d.toordinal() if r.d else 0, r.m, r.k, r.v, r.w)
        if r.k not in best or order > best[r.k][0]:
            best[r.k] = (order, (r.k, r.v, r.w))
    assert sorted(tuple(r) for r in got.collect()) == sorted(x for _, x in best.values())
    plain = mapping.extract_entity(t, _entity())
    plan = plain._jdf.queryExecution().executedPlan().toString()
    # the scan feeds a hash aggregation
    assert [x for x in plan.split("\n") if "Aggregate" in x][-1].strip(" :+-").startswith("HashAggregate")
    assert plain.where("k = 'hot'").first().v == max(r.v for r in t.collect() if r.k == "hot")


def test_nest_splits_a_hot_entity_in_order_of_mixed_codes(spark):
    rows = [("A", str(i % 3), str(i) if i % 2 else f"X{i}") for i in range(300)] + [("B", "1", "9"), ("B", "1", "13"), ("B", "1", "13")]
    df = spark.createDataFrame(rows, "agency string, sub string, office string")
    nested = relations.nest(df, [("agencies", ["agency"]), ("subs", ["sub"]), ("offices", ["office"])], chunk_size=20).collect()
    offices = {}
    for r in nested:
        for s in r["subs"]:
            assert len(s["offices"]) <= 20
            offices.setdefault((r["agency"], s["sub"]), []).append((s["offices_chunk"], [o["office"] for o in s["offices"]]))
    assert len(offices["A", "0"]) == 5
    for key, chunks in offices.items():
        flat = [o for _, part in sorted(chunks) for o in part]
        assert flat == sorted({o for a, s, o in rows if (a, s) == key})
    assert offices["B", "1"] == [(0, ["13", "9"])]


def test_nested_queries_match_at_a_larger_scale(spark):
    """Office numbers of two digits: text order, in Spark and SQL alike."""
    import duckdb

    import __spark_entry__ as E
    con = duckdb.connect()
    larger = "/root/testdata/sf0.01"
    for t in ("lineitem", "orders", "customer", "supplier", "nation", "region", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{larger}/{t}.parquet')")
    for name in ("nest_agency_offices", "nest_hierarchy"):
        df = E.queries()[name](spark, larger)
        res = con.execute(E.oracle_sql()[name])
        at = [[d[0] for d in res.description].index(c) for c in df.columns]
        assert sorted(map(tuple, df.collect())) == sorted(tuple(r[i] for i in at) for r in res.fetchall())


def _award_tables(spark, path):
    """A few transactions of odd kinds: missing dimensions, null dates and keys, repeated rows, ties of date and modification."""
    import datetime as dt
    day = lambda n: None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    lines = [(o, 1 + i % 5, 1 + (o + i) % 7, 1 + i % 3, 10.0 * o + i, 0.1, 0.05, "ANR"[i % 3], "OF"[i % 2],
              day(None if o == 4 else (i * o) % 4)) for o in [1, 2, 3, 4, 5, 6, 99] for i in range(9)]
    lines += lines[:5] + [(None, 1, 1, 1, 1.0, 0.0, 0.0, "A", "O", day(3)), (2, None, None, 2, 1.0, 0.0, 0.0, "A", "O", day(9))]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, "
                            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": ([(o, o % 4 or None, 5.0 * o, day(o)) for o in range(1, 7)] + [(2, 3, 1.0, day(1))],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"),
        "customer": ([(c, f"C{c}", c % 3, "AB"[c % 2], 500.0 * c) for c in range(1, 4)],
                     "c_custkey long, c_name string, c_nationkey long, c_mktsegment string, c_acctbal double"),
        "supplier": ([(s, f"S{s}", s % 4) for s in range(1, 6)] + [(1, "S1 again", 2)],
                     "s_suppkey long, s_name string, s_nationkey long"),
        "part": ([(p, f"P{p}", f"B{p % 2}", "T", p) for p in range(1, 5)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "nation": ([(n, f"N{n}", n % 2) for n in range(3)], "n_nationkey long, n_name string, n_regionkey long"),
        "region": ([(0, "R0"), (1, "R1")], "r_regionkey long, r_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def test_entities_of_reduced_transactions_are_those_of_all(spark):
    from fedlake.operators import mapping
    from fedlake.plans import entities as E
    from fedlake.plans import entity_queries as Q
    d = _award_tables(spark, scratch_path(spark, "t-award"))
    rows = lambda df: sorted(map(repr, mapping.flatten(df).collect()))
    for spec, order, got in [(E.CONTRACT, ["last_modified_date", "modification_number"], Q._contracts(spark, d)),
                             (E.RECIPIENT, E.RECIPIENT["order_by"], Q._recipients(spark, d))]:
        assert rows(got) == rows(mapping.extract_entity(E.transactions_for(spark, d, spec, extra=order), spec, order_by=order))
        # rows of earlier dates go before the dimensions are joined
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("LeftOuter") < plan.index("Inner")
    whole = mapping.extract_entity(E.transactions_for(spark, d, E.AGENCY), E.AGENCY)
    assert rows(mapping.extract_entity(E.agency_records(spark, d), E.AGENCY, reduced=True)) == rows(whole)


def test_keys_of_entities_need_no_record(spark):
    from fedlake.operators import mapping
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 2, None), (None, 3, "z")], "k string, w int, v string")
    keys = mapping.extract_entity(df, _entity(), fields=["k"])
    assert sorted(r.k for r in keys.collect()) == ["a", "b"]
    assert "SortAggregate" not in keys._jdf.queryExecution().executedPlan().toString()
    some = mapping.extract_entity(df, _entity(), fields=["v", "k"])
    assert sorted(map(tuple, some.collect()), key=repr) == [("y", "a"), (None, "b")]


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f for f in files if "/shuffle_" in f}


def test_written_tables_leave_no_shuffle_files(spark):
    from fedlake.session import materialize
    before = _shuffle_files(spark)
    _, n = materialize(spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count(), "t-release")
    assert n == 100
    materialize(spark.range(1000).repartition(7, "id"), "t-release")
    assert _shuffle_files(spark) <= before


def test_upsert_keeps_one_copy_of_its_rows(spark):
    import glob
    base = store.materialize(spark.range(1), "t-where")[0].inputFiles()[0].removeprefix("file:").split("fedlake-tables")[0]
    held = lambda: set(glob.glob(f"{base}fedlake-tables/store-*"))
    before, root = held(), scratch_path(spark, "t-copies")
    for kind in ("thing", "other", "other"):
        store.upsert(spark, store.to_store_rows(spark.range(30).selectExpr(f"'{kind}' as kind", "id"), kind), root)
    assert held() == before
    assert store.count_entities(spark, root).count() == 2 and store.read_store(spark, root).count() == 60


def test_upsert_of_repeated_ids_keeps_the_latest_of_each(spark):
    root = scratch_path(spark, "t-repeats")
    rows = spark.createDataFrame([("a" * 64, "t", 1, "old", 1), ("a" * 64, "t", 1, "new", 2), ("b" * 64, "t", 2, "x", 1),
                                  ("b" * 64, "u", 2, "x", 1), ("c" * 64, "t", 3, "p", 5), ("c" * 64, "t", 3, "q", 5)],
                                 "id string, entity_type string, shard int, data string, n int") \
        .select("id", "entity_type", "shard", "data", F.timestamp_seconds("n").alias("created_at"))
    assert store.upsert(spark, rows, root) == 4
    got = sorted((r.entity_type, r.id[0], r.data) for r in store.read_store(spark, root).collect())
    assert got == [("t", "a", "new"), ("t", "b", "x"), ("t", "c", "q"), ("u", "b", "x")]


def test_agency_keys_ask_later_sources_only_where_the_first_lack(spark):
    from fedlake.operators import mapping
    from fedlake.plans import entities as E
    d = _award_tables(spark, scratch_path(spark, "t-award"))
    keys = E.AGENCY["key_fields"]
    t = E.transactions_for(spark, d, E.AGENCY)
    assert t.where("awarding_office_code IS NULL OR awarding_sub_agency_code IS NULL OR awarding_agency_code IS NULL").count()
    want = mapping.extract_entity(t, E.AGENCY, fields=keys).select(*[F.col(k).cast("string") for k in keys])
    got = E.agency_keys(spark, d)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # transactions are filtered before the tables of the later sources are joined
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    orders = [i for i, line in enumerate(plan.splitlines()) if "(l_orderkey" in line and "Join" in line]
    assert len(orders) == 1 and any("Filter" in line and "isnull(lpad" in line for line in plan.splitlines()[orders[0]:])


def test_latest_transactions_exchange_the_key_of_the_table(spark):
    from fedlake.plans import entities as E
    d = _award_tables(spark, scratch_path(spark, "t-award"))
    t = E.latest_transactions(spark, d, E.CONTRACT, "contract_award_unique_key", E.CONTRACT["order_by"])
    # the text is made after the choice, so it is neither grouped by nor exchanged
    plan = t._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CONT_AWD_") == 1 and plan.index("CONT_AWD_") < plan.index("Aggregate")


def test_exchanges_follow_the_bytes_of_their_input(spark):
    from fedlake.session import EXCHANGE_INPUT, exchanges_for
    settings = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                "spark.sql.files.maxPartitionBytes")
    now = lambda: [spark.conf.get(k, None) for k in settings]
    parts = lambda: spark.range(9).groupBy(F.col("id") % 5).count()._jdf.queryExecution().executedPlan().toString()
    before, own = now(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    with exchanges_for(spark, (own + 3) * EXCHANGE_INPUT - 1):
        assert f", {own + 3})" in parts()
    with exchanges_for(spark, 0):  # never fewer than the session has
        assert f", {own})" in parts()
    assert now() == before


def test_agencies_are_exchanged_by_the_bytes_of_the_transactions(spark, monkeypatch):
    from fedlake import session
    from fedlake.operators import mapping
    from fedlake.plans import entities as E
    from fedlake.plans import entity_queries as Q
    d = _award_tables(spark, scratch_path(spark, "t-award"))
    monkeypatch.setattr(session, "EXCHANGE_INPUT", 64)  # as if the table were large
    seen, write = [], E.materialize

    def watched(df, name):
        seen.append(df.select("*")._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(E, "materialize", watched)
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(Q.q_extract_agency(spark, d)) == rows(mapping.extract_entity(E.transactions_for(spark, d, E.AGENCY), E.AGENCY))
    n = -(-session.table_bytes(spark, d, "lineitem") // 64)
    assert n > int(spark.conf.get("spark.sql.shuffle.partitions")) and f", {n})" in seen[0]


def _shuffles(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
    return {found.apply(i).name().split("_")[1] for i in range(found.size()) if found.apply(i).name().startswith("shuffle_")}


def test_exported_views_leave_no_exchange_on_disk(spark):
    from fedlake.sources import sinks
    views = {n: spark.range(2000).select((F.col("id") % 7).alias("g"), "id").orderBy("g", "id") for n in ("a", "b", "c")}
    before, path = _shuffles(spark), scratch_path(spark, "t-views")
    paths = sinks.export_views(views, path)
    assert not _shuffles(spark) - before
    assert [spark.read.parquet(paths[n]).count() for n in "abc"] == [2000] * 3


def test_latest_records_in_slices(spark):
    df = _skewed(spark)
    want = sorted((r.g, r.id, r.row_count) for r in summary.latest_records(df, "g", "day").collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sliced = summary.latest_records(df, "g", "day", slices=3)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan  # written, slice by slice
    assert sorted((r.g, r.id, r.row_count) for r in sliced.collect()) == want


def test_narrow_table_in_slices(spark, monkeypatch):
    from fedlake import session
    from fedlake.plans import award
    monkeypatch.setattr(session, "SLICE_BYTES", 40_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = award.award_slices(spark, SMOKE, None)
        plan = parts[0]._jdf.queryExecution().executedPlan().toString()
        table, n = session.materialize(parts, "t-narrow", compression="zstd")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    # lines meet parts, suppliers and orders; customers are joined to orders, nations to customers and suppliers
    assert len(parts) > 2 and plan.count("hashpartitioning(o_custkey") == 1 and plan.count("hashpartitioning(l_orderkey") == 1
    whole = award_narrow(spark, SMOKE)
    assert n == whole.count() and not whole.exceptAll(table).count()
