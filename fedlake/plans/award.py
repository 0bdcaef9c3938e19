"""The award schema bound onto the driver's TPC-H-ish tables.

A transaction is a ``lineitem`` row; its award (contract) is the ``orders``
row, the recipient is the ``customer`` (parent = the customer key rounded down
to a multiple of ten), the awarding office is the ``supplier`` and its
sub-agency the supplier's ``nation``; the funding sub-agency is the
customer's nation and the funding office the customer's market segment; the
product/service code is the ``part`` brand.

``award_narrow`` is column-driven: it joins only the dimensions the requested
columns need, always as left joins on the dimension's primary key, so a
dropped join never changes the row set. Every dimension join is size-checked
before it is broadcast.

Each narrow column also has a DuckDB SQL expression so the oracle builds the
very same table with plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import fiscal_year
from ..operators import summary
from ..operators.joins import join_small
from ..operators.mapping import latest_rows
from ..session import in_slice, load, slices_for, table_bytes


@dataclass(frozen=True)
class NarrowCol:
    build: Callable[[], Column]  # Spark side, built on use (needs a session)
    sql: str
    needs: tuple[str, ...] = ()
    one_to_one: str = ""  # the table column that this one only renames: equal where that is, null where that is


def _c(name):
    return F.col(name)


def _padded(prefix: str, n: Column, width: int) -> Column:
    """``prefix`` + zero-padded non-negative integer (``printf('%0Nd')``), without
    a per-row ``String.format`` call; longer numbers are kept whole."""
    s = n.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s))


# Business flags of a recipient, under their own names and renamed.
RECIPIENT_FLAGS = """
alaskan_native_corporation_owned_firm american_indian_owned_business indian_tribe_federally_recognized
native_hawaiian_organization_owned_firm tribally_owned_firm veteran_owned_business
service_disabled_veteran_owned_business woman_owned_business women_owned_small_business
economically_disadvantaged_women_owned_small_business joint_venture_women_owned_small_business
joint_venture_economic_disadvantaged_women_owned_small_bus minority_owned_business
subcontinent_asian_asian_indian_american_owned_business asian_pacific_american_owned_business
black_american_owned_business hispanic_american_owned_business native_american_owned_business
other_minority_owned_business corporate_entity_not_tax_exempt corporate_entity_tax_exempt
partnership_or_limited_liability_partnership sole_proprietorship small_agricultural_cooperative
international_organization us_government_entity manufacturer_of_goods small_business small_disadvantaged_business
emerging_small_business c8a_program_participant historically_underutilized_business_zone_hubzone_firm
minority_institution school_of_forestry veterinary_college hispanic_servicing_institution
foreign_owned_and_located for_profit_organization nonprofit_organization other_not_for_profit_organization
community_developed_corporation_owned_firm labor_surplus_area_firm sam_registered
sam_entity_information_currently_active
""".split()
RENAMED_FLAGS = {
    "land_grant_college_1862": "1862_land_grant_college",
    "land_grant_college_1890": "1890_land_grant_college",
    "land_grant_college_1994": "1994_land_grant_college",
    "historically_black_college_or_university": "historically_black_college",
}


@lru_cache(maxsize=1)
def narrow_spec() -> dict[str, NarrowCol]:
    """Award column -> (Spark Column builder, DuckDB SQL, dimensions needed)."""
    spec = {
        "contract_transaction_unique_key": NarrowCol(
            lambda: F.concat_ws("_", _c("l_orderkey").cast("string"), _c("l_linenumber").cast("string")),
            "concat_ws('_', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR))"),
        "award_id_piid": NarrowCol(lambda: _c("l_orderkey"), "l.l_orderkey"),
        "modification_number": NarrowCol(lambda: _c("l_linenumber"), "l.l_linenumber"),
        "action_date_fiscal_year": NarrowCol(lambda: fiscal_year(_c("l_shipdate"), 10),
                                             "CAST(year(CAST(l.l_shipdate AS DATE) + INTERVAL 3 MONTH) AS INTEGER)"),
        "awarding_sub_agency_code": NarrowCol(lambda: _c("s_nationkey"), "s.s_nationkey", ("supplier",)),
        "awarding_sub_agency_name": NarrowCol(lambda: _c("sn_name"), "sn.n_name", ("supplier", "snation")),
        "awarding_office_code": NarrowCol(lambda: _c("l_suppkey"), "l.l_suppkey"),
        "awarding_office_name": NarrowCol(lambda: _c("s_name"), "s.s_name", ("supplier",)),
        "funding_sub_agency_code": NarrowCol(lambda: _c("c_nationkey"), "c.c_nationkey", ("orders", "customer")),
        "funding_sub_agency_name": NarrowCol(lambda: _c("cn_name"), "cn.n_name", ("orders", "customer", "cnation")),
        "funding_office_code": NarrowCol(lambda: _c("c_mktsegment"), "c.c_mktsegment", ("orders", "customer")),
        "funding_office_name": NarrowCol(lambda: F.lower(_c("c_mktsegment")), "lower(c.c_mktsegment)", ("orders", "customer")),
        "recipient_uei": NarrowCol(lambda: _c("o_custkey"), "o.o_custkey", ("orders",), "o_custkey"),
        "recipient_name": NarrowCol(lambda: _c("c_name"), "c.c_name", ("orders", "customer")),
        "recipient_name_raw": NarrowCol(lambda: F.upper(_c("c_name")), "upper(c.c_name)", ("orders", "customer")),
        "recipient_parent_uei": NarrowCol(lambda: F.floor(_c("o_custkey") / 10) * 10,
                                          "CAST(floor(o.o_custkey / 10) * 10 AS BIGINT)", ("orders",)),
        "recipient_parent_name": NarrowCol(lambda: _padded("Parent#", F.floor(_c("o_custkey") / 10) * 10, 9),
                                           "printf('Parent#%09d', CAST(floor(o.o_custkey / 10) * 10 AS BIGINT))",
                                           ("orders",)),
        "recipient_parent_name_raw": NarrowCol(lambda: _padded("PARENT#", F.floor(_c("o_custkey") / 10) * 10, 9),
                                               "printf('PARENT#%09d', CAST(floor(o.o_custkey / 10) * 10 AS BIGINT))",
                                               ("orders",)),
        "transaction_description": NarrowCol(lambda: _c("p_name"), "p.p_name", ("part",)),
        "product_or_service_code": NarrowCol(lambda: _c("p_brand"), "p.p_brand", ("part",)),
        "product_or_service_code_description": NarrowCol(lambda: _c("p_type"), "p.p_type", ("part",)),
        "federal_action_obligation": NarrowCol(
            lambda: (_c("l_extendedprice").cast("decimal(18,2)") * (1 - _c("l_discount").cast("decimal(18,2)")))
            .cast("decimal(18,2)"),
            "CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2))) "
            "AS DECIMAL(18,2))"),
        "total_dollars_obligated": NarrowCol(lambda: _c("o_totalprice").cast("decimal(18,2)"),
                                             "CAST(o.o_totalprice AS DECIMAL(18,2))", ("orders",)),
        "base_and_all_options_value": NarrowCol(
            lambda: (_c("l_extendedprice").cast("decimal(18,2)") * (1 + _c("l_tax").cast("decimal(18,2)")))
            .cast("decimal(18,2)"),
            "CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l.l_tax AS DECIMAL(18,2))) "
            "AS DECIMAL(18,2))"),
        "potential_total_value_of_award": NarrowCol(lambda: _c("l_extendedprice"), "l.l_extendedprice"),
        "award_permalink": NarrowCol(lambda: F.concat(F.lit("/award/"), _c("l_orderkey").cast("string")),
                                           "'/award/' || CAST(l.l_orderkey AS VARCHAR)"),
        "last_modified_date": NarrowCol(lambda: _c("l_shipdate"), "l.l_shipdate"),
        # wider transaction columns used by the entity mappings
        "contract_award_unique_key": NarrowCol(lambda: F.concat(F.lit("CONT_AWD_"), _c("l_orderkey").cast("string")),
                                               "'CONT_AWD_' || CAST(l.l_orderkey AS VARCHAR)", one_to_one="l_orderkey"),
        "parent_award_id_piid": NarrowCol(lambda: F.floor(_c("l_orderkey") / 8) * 8,
                                          "CAST(floor(l.l_orderkey / 8) * 8 AS BIGINT)"),
        "awarding_agency_code": NarrowCol(lambda: F.lpad(_c("sn_region").cast("string"), 3, "0"),
                                          "lpad(CAST(sn.n_regionkey AS VARCHAR), 3, '0')", ("supplier", "snation")),
        "awarding_agency_name": NarrowCol(lambda: _c("sr_name"), "sr.r_name", ("supplier", "snation", "sregion")),
        "funding_agency_code": NarrowCol(lambda: F.lpad(_c("cn_region").cast("string"), 3, "0"),
                                         "lpad(CAST(cn.n_regionkey AS VARCHAR), 3, '0')",
                                         ("orders", "customer", "cnation")),
        "funding_agency_name": NarrowCol(lambda: _c("cr_name"), "cr.r_name",
                                         ("orders", "customer", "cnation", "cregion")),
        "recipient_parent_uei_text": NarrowCol(lambda: (F.floor(_c("o_custkey") / 10) * 10).cast("string"),
                                               "CAST(CAST(floor(o.o_custkey / 10) * 10 AS BIGINT) AS VARCHAR)",
                                               ("orders",)),
        "recipient_country_code": NarrowCol(lambda: _c("cn_name"), "cn.n_name", ("orders", "customer", "cnation")),
        "recipient_state_code": NarrowCol(lambda: F.lpad(_c("c_nationkey").cast("string"), 2, "0"),
                                          "lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0')", ("orders", "customer")),
        "recipient_city_name": NarrowCol(lambda: _c("c_mktsegment"), "c.c_mktsegment", ("orders", "customer")),
        "recipient_county_name": NarrowCol(lambda: _c("cr_name"), "cr.r_name",
                                           ("orders", "customer", "cnation", "cregion")),
        "recipient_zip_4_code": NarrowCol(lambda: _padded("", _c("o_custkey"), 5),
                                          "printf('%05d', o.o_custkey)", ("orders",)),
        "recipient_address_line_1": NarrowCol(lambda: F.concat(_c("c_name"), F.lit(" Way")), "c.c_name || ' Way'",
                                              ("orders", "customer")),
        "recipient_phone_number": NarrowCol(
            lambda: F.concat(_padded("(", _c("c_nationkey") + 200, 3), F.lit(") 555-"),
                             _padded("", _c("o_custkey") % 10000, 4)),
            "printf('(%03d) 555-%04d', c.c_nationkey + 200, o.o_custkey % 10000)", ("orders", "customer")),
        "primary_place_of_performance_country_code": NarrowCol(lambda: _c("sn_name"), "sn.n_name",
                                                               ("supplier", "snation")),
        "primary_place_of_performance_state_code": NarrowCol(lambda: F.lpad(_c("s_nationkey").cast("string"), 2, "0"),
                                                             "lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0')",
                                                             ("supplier",)),
        "primary_place_of_performance_city_name": NarrowCol(lambda: F.lit("DEPOT"), "'DEPOT'"),
        "primary_place_of_performance_county_name": NarrowCol(lambda: _c("sr_name"), "sr.r_name",
                                                              ("supplier", "snation", "sregion")),
        "primary_place_of_performance_zip_4": NarrowCol(lambda: _padded("", _c("l_suppkey"), 5),
                                                        "printf('%05d', l.l_suppkey)"),
        "naics_code": NarrowCol(lambda: _padded("", _c("p_size") * 1000, 6), "printf('%06d', p.p_size * 1000)",
                                ("part",)),
        "naics_description": NarrowCol(lambda: _c("p_type"), "p.p_type", ("part",)),
        "award_type": NarrowCol(lambda: _c("l_returnflag"), "l.l_returnflag"),
        "action_type": NarrowCol(lambda: _c("l_linestatus"), "l.l_linestatus"),
        "action_date": NarrowCol(lambda: _c("o_orderdate"), "o.o_orderdate", ("orders",)),
        "period_of_performance_start_date": NarrowCol(lambda: _c("o_orderdate"), "o.o_orderdate", ("orders",)),
        "period_of_performance_current_end_date": NarrowCol(lambda: _c("l_shipdate"), "l.l_shipdate"),
        "total_outlayed_amount_for_overall_award": NarrowCol(
            lambda: (_c("l_extendedprice").cast("decimal(18,2)") * _c("l_discount").cast("decimal(18,2)"))
            .cast("decimal(18,2)"),
            "CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(18,2)) "
            "AS DECIMAL(18,2))"),
        "base_and_exercised_options_value": NarrowCol(
            lambda: (_c("l_extendedprice").cast("decimal(18,2)") * _c("l_tax").cast("decimal(18,2)"))
            .cast("decimal(18,2)"),
            "CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(18,2)) "
            "AS DECIMAL(18,2))"),
        "current_total_value_of_award": NarrowCol(lambda: _c("o_totalprice"), "o.o_totalprice", ("orders",)),
        "prime_award_transaction_recipient_cd_current": NarrowCol(
            lambda: F.concat(F.lpad(_c("c_nationkey").cast("string"), 2, "0"), F.lit("-"),
                             F.lpad((_c("o_custkey") % 12).cast("string"), 2, "0")),
            "lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') || '-' || lpad(CAST(o.o_custkey % 12 AS VARCHAR), 2, '0')",
            ("orders", "customer")),
        "veteran_owned_business": NarrowCol(
            lambda: F.when(_c("c_mktsegment") == "AUTOMOBILE", "t").otherwise("f"),
            "CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 't' ELSE 'f' END", ("orders", "customer")),
        "emerging_small_business": NarrowCol(
            lambda: F.when(_c("c_acctbal") < 1000, "t").otherwise("f"),
            "CASE WHEN c.c_acctbal < 1000 THEN 't' ELSE 'f' END", ("orders", "customer")),
    }
    for i, flag in enumerate([*RECIPIENT_FLAGS, *RENAMED_FLAGS.values()]):
        spec.setdefault(flag, _stand_in_flag(i + 2))
    return spec


def _stand_in_flag(k: int) -> NarrowCol:
    return NarrowCol(lambda: F.when(_c("o_custkey") % k == 0, "t").otherwise("f"),
                     f"CASE WHEN o.o_custkey % {k} = 0 THEN 't' ELSE 'f' END", ("orders",))


# dimension name -> (table, renamed projection, join keys, sql join clause)
_DIMS = {
    "orders": ("orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"], ("l_orderkey", "o_orderkey"),
               "LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey"),
    "customer": ("customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal"], ("o_custkey", "c_custkey"),
                 "LEFT JOIN customer c ON o.o_custkey = c.c_custkey"),
    "cnation": ("nation", [("n_nationkey", "cn_key"), ("n_name", "cn_name"), ("n_regionkey", "cn_region")],
                ("c_nationkey", "cn_key"), "LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey"),
    "cregion": ("region", [("r_regionkey", "cr_key"), ("r_name", "cr_name")], ("cn_region", "cr_key"),
                "LEFT JOIN region cr ON cn.n_regionkey = cr.r_regionkey"),
    "supplier": ("supplier", ["s_suppkey", "s_name", "s_nationkey"], ("l_suppkey", "s_suppkey"),
                 "LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey"),
    "snation": ("nation", [("n_nationkey", "sn_key"), ("n_name", "sn_name"), ("n_regionkey", "sn_region")],
                ("s_nationkey", "sn_key"), "LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey"),
    "sregion": ("region", [("r_regionkey", "sr_key"), ("r_name", "sr_name")], ("sn_region", "sr_key"),
                "LEFT JOIN region sr ON sn.n_regionkey = sr.r_regionkey"),
    "part": ("part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"], ("l_partkey", "p_partkey"),
             "LEFT JOIN part p ON l.l_partkey = p.p_partkey"),
}
_DIM_ORDER = ["orders", "customer", "cnation", "cregion", "supplier", "snation", "sregion", "part"]

DEFAULT_NARROW = summary.narrow_fields()


def _needed_dims(columns: Iterable[str]) -> list[str]:
    need: set[str] = set()
    for c in columns:
        need.update(narrow_spec()[c].needs)
    return [d for d in _DIM_ORDER if d in need]


def award_narrow(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None, *,
                 latest: tuple[str, str] | None = None,
                 distinct: tuple[Sequence[str], Sequence[str]] | None = None,
                 where: tuple[Sequence[str], Callable[[DataFrame], Column]] | None = None,
                 part: tuple[int, int] | None = None) -> DataFrame:
    """Narrow award-transaction table (the analysis table) from the test tables.

    For a consumer that reads only some rows, these go before the dimensions widen and exchange them; every dimension is a
    left join, so the rows that stay are the same as if they went at the end. ``latest`` (key, order) keeps the rows with the largest
    order value of their key, chosen as soon as the two columns are there. ``distinct`` (dimensions, table columns) joins these
    dimensions first and keeps each combination of the table columns once; all requested columns must follow from those.
    ``where`` (award columns, condition made from a table that has them) keeps the rows for which the condition holds.
    ``part`` (i, of n) builds slice i of n by the order key; see ``award_slices``."""
    columns = list(DEFAULT_NARROW if columns is None else columns)

    def side(dim: str) -> DataFrame:
        table, proj, _, _ = _DIMS[dim]
        return load(spark, sf_dir, table).select(*[F.col(p) if isinstance(p, str) else F.col(p[0]).alias(p[1]) for p in proj])

    def joined(df: DataFrame, dims: Iterable[str]) -> DataFrame:
        for dim in dims:
            lk, rk = _DIMS[dim][2]
            df = join_small(df, side(dim), F.col(lk) == F.col(rk), "left")
        return df

    if part is not None:
        return _narrow_part(load(spark, sf_dir, "lineitem"), columns, side, joined, *part)

    first = _needed_dims(latest) if latest else list(distinct[0]) if distinct else _needed_dims(where[0]) if where else []
    df = joined(load(spark, sf_dir, "lineitem"), first)
    if latest:
        own, (key, order) = df.columns, [narrow_spec()[c] for c in latest]
        # the table's column instead of its renaming: the exchanges carry a number, and no second copy as text
        df = df.select("*", order.build().alias("__order"), *[] if key.one_to_one else [key.build().alias("__key")])
        df = latest_rows(df, [key.one_to_one or "__key"], "__order").select(*own)
    elif distinct:
        df = df.select(*distinct[1]).distinct()
    elif where:
        own = df.columns
        df = df.select("*", *[narrow_spec()[c].build().alias(c) for c in where[0]])
        df = df.where(where[1](df)).select(*own)
    df = joined(df, [d for d in _needed_dims(columns) if d not in first])
    return df.select(*[narrow_spec()[c].build().alias(c) for c in columns])


def _narrow_part(lines: DataFrame, columns: list[str], side: Callable[[str], DataFrame],
                 joined: Callable[[DataFrame, Iterable[str]], DataFrame], part: int, of: int) -> DataFrame:
    """Slice ``part`` of ``of`` of the narrow table, by the order key. The orders get their customers before the lines get
    their orders, so that lines are not exchanged by customer, and the lines' own dimensions come first: joined last by
    order, the rows of an order lie together, and its columns take little room when they are written."""
    dims = _needed_dims(columns)
    chain = [d for d in dims if d in ("orders", "customer", "cnation", "cregion")]
    lk, rk = _DIMS["orders"][2]
    df = joined(lines.where(in_slice([F.col(lk)], part, of)) if of > 1 else lines, [d for d in dims if d not in chain])
    if chain:
        orders = side("orders")
        orders = joined(orders.where(in_slice([F.col(rk)], part, of)) if of > 1 else orders, chain[1:])
        df = join_small(df, orders, F.col(lk) == F.col(rk), "left")
    return df.select(*[narrow_spec()[c].build().alias(c) for c in columns])


def award_slices(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> list[DataFrame]:
    """``award_narrow`` in as many slices as the transactions' bytes ask for: the rows of all are the table's. To be written
    one after the other (``materialize``), so that the exchanges on disk are those of one."""
    n = slices_for(table_bytes(spark, sf_dir, "lineitem"))
    return [award_narrow(spark, sf_dir, columns, part=(i, n)) for i in range(n)]


def award_narrow_sql(columns: Iterable[str] | None = None) -> str:
    """The same narrow table as a DuckDB SELECT (for the oracle)."""
    columns = list(DEFAULT_NARROW if columns is None else columns)
    joins = " ".join(_DIMS[d][3] for d in _needed_dims(columns))
    sel = ", ".join(f'{narrow_spec()[c].sql} AS "{c}"' for c in columns)
    return f"SELECT {sel} FROM lineitem l {joins}"


# The eight analysis views: (query key, group field, additional fields).
VIEWS = [
    ("view_award", "award_id_piid", []),
    ("view_recipient", "recipient_uei",
     ["recipient_name", "recipient_name_raw", "recipient_parent_name", "recipient_parent_name_raw"]),
    ("view_parent", "recipient_parent_uei",
     ["recipient_parent_name", "recipient_parent_name_raw", "recipient_name", "recipient_name_raw"]),
    ("view_psc", "product_or_service_code", ["product_or_service_code_description"]),
    ("view_awarding_subagency", "awarding_sub_agency_code", ["awarding_sub_agency_name"]),
    ("view_awarding_office", "awarding_office_code", ["awarding_office_name"]),
    ("view_funding_subagency", "funding_sub_agency_code", ["funding_sub_agency_name"]),
    ("view_funding_office", "funding_office_code", ["funding_office_name"]),
]

VIEW_BASE_FIELDS = [f for f in summary.default_fields() if f != "row_count"]


def view_columns(group: str, extras: list[str]) -> list[str]:
    return list(dict.fromkeys([group] + VIEW_BASE_FIELDS + extras))
