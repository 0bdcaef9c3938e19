"""Summary analysis queries: flagship, eight views, and the pieces they use."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import fmt_date
from ..operators import setops, summary
from ..operators.filters import filter_contains_ci
from ..session import load
from .award import VIEWS, award_narrow, award_narrow_sql, view_columns
from .catalog import register

CURRENCY_SQL = "'$' || format('{{:,.2f}}', {c})"
DATE_SQL = "strftime({c}, '%Y-%m-%d')"


def latest_sql(source: str, group: str, date: str, value: str, fields: list[str],
               tiebreak_limit: str = "") -> str:
    """Oracle for latest-per-group: the source's own group-max / merge / count /
    merge formulation in SQL."""
    sel = []
    for f in fields:
        if f == "row_count":
            sel.append("c.row_count")
        elif f == value:
            sel.append(CURRENCY_SQL.format(c=f"t.{f}") + f" AS {f}")
        elif f == date:
            sel.append(DATE_SQL.format(c=f"t.{f}") + f" AS {f}")
        else:
            sel.append(f"t.{f}")
    return (
        f"WITH src AS ({source}), "
        f"g AS (SELECT {group}, max({date}) AS m FROM src WHERE {group} IS NOT NULL GROUP BY {group}), "
        f"t AS (SELECT s.* FROM src s JOIN g ON s.{group} = g.{group} AND s.{date} IS NOT DISTINCT FROM g.m), "
        f"c AS (SELECT {group}, count(*) AS row_count FROM t GROUP BY {group}) "
        f"SELECT {', '.join(sel)} FROM t JOIN c ON t.{group} = c.{group} {tiebreak_limit}"
    )


# --- flagship ---------------------------------------------------------------

ORDERS_FIELDS = ["o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice", "row_count", "o_orderdate"]


def _facts(spark, sf_dir, name):
    # the scan feeds a partial aggregation directly: no round-robin spread
    return load(spark, sf_dir, name)


def flagship(spark, sf_dir):
    """A3 on ``orders``: latest order(s) per customer, sorted by total price."""
    orders = _facts(spark, sf_dir, "orders")
    return summary.latest_by_group(orders, "o_custkey", "o_orderdate", "o_totalprice", fields=ORDERS_FIELDS)


register("latest_by_group", latest_sql("SELECT * FROM orders", "o_custkey", "o_orderdate", "o_totalprice",
                                       ["o_custkey"] + ORDERS_FIELDS))(flagship)

LINE_FIELDS = ["l_orderkey", "l_linenumber", "l_extendedprice", "row_count", "l_shipdate"]


@register("latest_by_part", latest_sql("SELECT * FROM lineitem", "l_partkey", "l_shipdate", "l_extendedprice",
                                       ["l_partkey"] + LINE_FIELDS))
def latest_by_part(spark, sf_dir):
    """A3 on ``lineitem`` grouped by part (a wider fact table, 1 row per line)."""
    li = _facts(spark, sf_dir, "lineitem")
    return summary.latest_by_group(li, "l_partkey", "l_shipdate", "l_extendedprice", fields=LINE_FIELDS)


# --- A4: the eight views ------------------------------------------------------

VIEW_FIELDS_ORDER = summary.default_fields()


def _make_view(key, group, extras):
    cols = view_columns(group, extras)

    def run(spark, sf_dir):
        narrow = award_narrow(spark, sf_dir, cols)
        return summary.latest_by_group(narrow, group, additional_fields=extras)

    run.__name__ = key
    run.__doc__ = f"A4 view: latest award record(s) per {group}, with {', '.join(extras) or 'no extra fields'}."
    out_fields = [group] + VIEW_FIELDS_ORDER + [e for e in extras if e not in VIEW_FIELDS_ORDER and e != group]
    sql = latest_sql(award_narrow_sql(cols), group, "last_modified_date", "potential_total_value_of_award",
                     out_fields)
    register(key, sql)(run)


for _key, _group, _extras in VIEWS:
    _make_view(_key, _group, _extras)


# --- A1, A2, J1, J2 -------------------------------------------------------------

@register("group_max", "SELECT o_custkey, max(o_orderdate) AS max_date FROM orders "
                       "WHERE o_custkey IS NOT NULL GROUP BY o_custkey")
def q_group_max(spark, sf_dir):
    """A1: latest order date per customer."""
    return summary.group_max(_facts(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@register("group_size", "SELECT l_suppkey, count(*) AS row_count FROM lineitem "
                        "WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey")
def q_group_size(spark, sf_dir):
    """A2: line count per supplier."""
    return summary.group_size(_facts(spark, sf_dir, "lineitem"), "l_suppkey")


@register("join_inner_composite",
          "SELECT o.o_orderkey, o.o_custkey, o.o_orderdate FROM orders o JOIN "
          "(SELECT o_custkey, max(o_orderdate) AS m FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey) g "
          "ON o.o_custkey = g.o_custkey AND o.o_orderdate IS NOT DISTINCT FROM g.m")
def q_join_inner_composite(spark, sf_dir):
    """Rows joined to their group's max date on (group, date), null-safe."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    g = summary.group_max(o, "o_custkey", "o_orderdate", "_m").withColumnRenamed("o_custkey", "_g")
    cond = (F.col("o_custkey") == F.col("_g")) & F.col("o_orderdate").eqNullSafe(F.col("_m"))
    from ..operators.joins import join_small
    return join_small(o, g, cond, "inner", materialize=True).select("o_orderkey", "o_custkey", "o_orderdate")


@register("join_back_count",
          "WITH g AS (SELECT l_suppkey, max(l_shipdate) AS m FROM lineitem WHERE l_suppkey IS NOT NULL "
          "GROUP BY l_suppkey), t AS (SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_shipdate FROM lineitem l "
          "JOIN g ON l.l_suppkey = g.l_suppkey AND l.l_shipdate IS NOT DISTINCT FROM g.m), "
          "c AS (SELECT l_suppkey, count(*) AS row_count FROM t GROUP BY l_suppkey) "
          "SELECT t.*, c.row_count FROM t JOIN c ON t.l_suppkey = c.l_suppkey")
def q_join_back_count(spark, sf_dir):
    """J1 + J2 in the source's join form: tied rows, then counts joined back."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    return summary.latest_by_group_join_form(li, "l_suppkey", "l_shipdate")


# --- T1-T3 ------------------------------------------------------------------------

@register("sort_mixed",
          "SELECT o_custkey, o_orderdate, o_orderkey, row_number() OVER (ORDER BY o_custkey ASC NULLS LAST, "
          "o_orderdate DESC NULLS LAST, o_orderkey ASC NULLS LAST) AS pos FROM orders")
def q_sort_mixed(spark, sf_dir):
    """Key asc, date desc (nulls last) with the global position as a column."""
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return summary.with_position(o, [("o_custkey", True), ("o_orderdate", False), ("o_orderkey", True)])


_TOP_COLS = ["award_id_piid", "modification_number", "transaction_description", "potential_total_value_of_award"]


@register("top_100",
          f"SELECT * FROM ({award_narrow_sql(_TOP_COLS)}) "
          "WHERE coalesce(contains(upper(transaction_description), 'RED'), false) "
          "ORDER BY potential_total_value_of_award DESC NULLS LAST, award_id_piid, modification_number LIMIT 100")
def q_top_100(spark, sf_dir):
    """P3 + T2: case-insensitive product filter, then the 100 largest by value."""
    narrow = award_narrow(spark, sf_dir, _TOP_COLS)
    hits = narrow.where(filter_contains_ci("transaction_description", "red"))
    return summary.top_n(hits, [("potential_total_value_of_award", False), ("award_id_piid", True),
                                ("modification_number", True)], 100)


@register("head_5",
          latest_sql("SELECT * FROM orders", "o_custkey", "o_orderdate", "o_totalprice",
                     ["o_custkey"] + ORDERS_FIELDS,
                     "ORDER BY t.o_totalprice DESC NULLS LAST, t.o_custkey, t.o_orderkey LIMIT 5"))
def q_head_5(spark, sf_dir):
    """First five rows of the flagship report (total order with tiebreak)."""
    orders = _facts(spark, sf_dir, "orders")
    return summary.latest_by_group(orders, "o_custkey", "o_orderdate", "o_totalprice", fields=ORDERS_FIELDS,
                                   tiebreak=["o_orderkey"]).limit(5)


# --- P1-P3 ------------------------------------------------------------------------

@register("narrow_projection", award_narrow_sql())
def q_narrow_projection(spark, sf_dir):
    """The narrow analysis table (26 award columns bound onto the test tables)."""
    return award_narrow(spark, sf_dir)


@register("cast_timestamp",
          "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP) AS order_ts FROM orders")
def q_cast_timestamp(spark, sf_dir):
    """Text date -> timestamp (bad text -> null under ANSI via try_)."""
    o = load(spark, sf_dir, "orders")
    txt = fmt_date("o_orderdate")
    return o.select("o_orderkey", F.try_to_timestamp(txt).cast("timestamp_ntz").alias("order_ts"))


@register("filter_contains_ci",
          f"SELECT award_id_piid, modification_number, transaction_description FROM "
          f"({award_narrow_sql(['award_id_piid', 'modification_number', 'transaction_description'])}) "
          "WHERE coalesce(contains(upper(transaction_description), upper('Red W')), false)")
def q_filter_contains_ci(spark, sf_dir):
    """Literal, case-insensitive substring filter; null -> no match."""
    narrow = award_narrow(spark, sf_dir, ["award_id_piid", "modification_number", "transaction_description"])
    return narrow.where(filter_contains_ci("transaction_description", "Red W"))


# --- U1-U3 --------------------------------------------------------------------------

@register("union_by_name",
          "SELECT o_orderkey AS order_key, o_totalprice AS amount, NULL::DOUBLE AS quantity FROM orders "
          "UNION ALL BY NAME SELECT l_orderkey AS order_key, l_quantity AS quantity FROM lineitem")
def q_union_by_name(spark, sf_dir):
    """Union all by column name; columns missing on one side are null."""
    a = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"),
                                             F.col("o_totalprice").alias("amount"))
    b = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"),
                                               F.col("l_quantity").alias("quantity"))
    return setops.union_by_name([a, b])


@register("set_except",
          "SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders")
def q_set_except(spark, sf_dir):
    """Customers with no orders (distinct set difference)."""
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    o = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"))
    return setops.set_except(c, o)


@register("set_union",
          "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def q_set_union(spark, sf_dir):
    """Distinct union of nation keys used by customers and suppliers."""
    c = load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return setops.set_union(c, s)


@register("latest_with_total",
          "WITH g AS (SELECT o_custkey, max(o_orderdate) AS m, count(*) AS total_count FROM orders "
          "WHERE o_custkey IS NOT NULL GROUP BY o_custkey), "
          "t AS (SELECT o.*, g.total_count FROM orders o JOIN g ON o.o_custkey = g.o_custkey "
          "AND o.o_orderdate IS NOT DISTINCT FROM g.m), "
          "c AS (SELECT o_custkey, count(*) AS row_count FROM t GROUP BY o_custkey) "
          "SELECT t.o_custkey, t.o_orderkey, '$' || format('{:,.2f}', t.o_totalprice) AS o_totalprice, c.row_count, "
          "t.total_count, strftime(t.o_orderdate, '%Y-%m-%d') AS o_orderdate FROM t JOIN c ON t.o_custkey = c.o_custkey")
def q_latest_with_total(spark, sf_dir):
    """A3 with ``total_count``: the latest order(s) per customer, the number
    tied at the latest date and the customer's total number of orders."""
    orders = _facts(spark, sf_dir, "orders")
    return summary.latest_by_group(orders, "o_custkey", "o_orderdate", "o_totalprice",
                                   fields=["o_orderkey", "o_totalprice", "row_count", "o_orderdate"], with_total=True)
