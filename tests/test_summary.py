"""Latest-per-group (A3) trap rows, join form, sorting and plan shape."""

import datetime as dt

from pyspark.sql import functions as F

from fedlake.operators import summary

D = dt.datetime


def _rows(spark):
    data = [
        ("a", 1, D(2024, 1, 1), 10.0),
        ("a", 2, D(2024, 2, 1), 30.0),   # tie at max
        ("a", 3, D(2024, 2, 1), 20.0),   # tie at max
        ("b", 4, None, 5.0),             # group whose dates are all null
        ("b", 5, None, None),            # null value sorts last
        ("c", 6, None, 7.0),             # null date beside a real one
        ("c", 7, D(2023, 5, 5), -1234.5),  # negative value
        (None, 8, D(2025, 1, 1), 99.0),  # null group key dropped
    ]
    return spark.createDataFrame(data, "g string, k int, d timestamp_ntz, v double")


def test_latest_records_traps(spark):
    out = {(r.g, r.k): r.row_count for r in summary.latest_records(_rows(spark), "g", "d").collect()}
    assert out == {("a", 2): 2, ("a", 3): 2, ("b", 4): 2, ("b", 5): 2, ("c", 7): 1}


def test_join_form_equals_aggregate_form(spark):
    df = _rows(spark)
    a = sorted((r.g, r.k, r.row_count) for r in summary.latest_records(df, "g", "d").collect())
    b = sorted((r.g, r.k, r.row_count) for r in summary.latest_by_group_join_form(df, "g", "d").collect())
    assert a == b


def test_report_sort_and_format(spark):
    rep = summary.latest_by_group(_rows(spark), "g", "d", "v", fields=["k", "v", "row_count", "d"]).collect()
    assert [r.k for r in rep] == [2, 3, 4, 7, 5]          # value desc, null last
    assert rep[0].v == "$30.00" and rep[0].d == "2024-02-01"
    assert rep[3].v == "$-1,234.50"
    assert rep[-1].v is None and rep[-1].d is None


def test_many_views_equal_single(spark):
    df = _rows(spark).withColumn("h", F.when(F.col("k") > 4, "x").otherwise("y"))
    many = summary.latest_by_group_many(df, [("g", []), ("h", [])], "d", "v", fields=["k", "row_count"])
    for view, grp in zip(many, ["g", "h"]):
        single = summary.latest_by_group(df, grp, "d", "v", fields=["k", "row_count"])
        assert sorted(map(tuple, view.collect())) == sorted(map(tuple, single.collect()))


def test_plan_has_no_window_and_broadcasts_group_table(spark):
    rep = summary.latest_by_group(_rows(spark), "g", "d", "v", fields=["k", "v", "row_count", "d"])
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_with_position_is_global_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("x"))
    pos = summary.with_position(df, [("x", True)]).collect()
    assert sorted((r.pos, r.x) for r in pos) == [(i + 1, i) for i in range(1000)]


def test_group_size_and_max_drop_null_keys(spark):
    df = _rows(spark)
    assert {r.g: r.row_count for r in summary.group_size(df, "g").collect()} == {"a": 3, "b": 2, "c": 2}
    assert {r.g for r in summary.group_max(df, "g", "d").collect()} == {"a", "b", "c"}
