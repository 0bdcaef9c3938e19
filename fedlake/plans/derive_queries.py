"""Row-wise derivations (A5, A6, F51, X1) over ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import derive
from ..session import load
from .catalog import register

# a third source with real nulls: zero taxes read as missing
_SRC_SQL = "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, nullif(l_tax, 0) AS tax FROM lineitem"


def _src(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                     F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"))


_COLS = ["l_quantity", "l_discount", "tax"]
_D = "CAST({c} AS DECIMAL(38,6))"
_SUM_SQL = " + ".join(f"coalesce({_D.format(c=c)}, 0)" for c in _COLS)
_CNT_SQL = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in _COLS)


@register("derive_sum",
          f"SELECT l_orderkey, l_linenumber, CAST(CASE WHEN ({_CNT_SQL}) > 0 THEN {_SUM_SQL} END AS DECIMAL(18,6)) "
          f"AS total FROM ({_SRC_SQL})")
def q_derive_sum(spark, sf_dir):
    """A5: null-skipping sum across columns (as a decimal)."""
    return _src(spark, sf_dir).select("l_orderkey", "l_linenumber",
                                      derive.derive_sum(_COLS).cast("decimal(18,6)").alias("total"))


@register("derive_avg",
          f"SELECT l_orderkey, l_linenumber, CAST(CASE WHEN ({_CNT_SQL}) > 0 THEN ({_SUM_SQL}) / ({_CNT_SQL}) END "
          f"AS DECIMAL(18,6)) AS mean FROM ({_SRC_SQL})")
def q_derive_avg(spark, sf_dir):
    """A5: mean of the non-null values across columns."""
    return _src(spark, sf_dir).select("l_orderkey", "l_linenumber",
                                      derive.derive_avg(_COLS).cast("decimal(18,6)").alias("mean"))


@register("derive_count",
          f"SELECT l_orderkey, l_linenumber, CAST({_CNT_SQL} AS INTEGER) AS n_present FROM ({_SRC_SQL})")
def q_derive_count(spark, sf_dir):
    """A5: count of non-null values across columns."""
    return _src(spark, sf_dir).select("l_orderkey", "l_linenumber", derive.derive_count(_COLS).alias("n_present"))


@register("derive_min",
          f"SELECT l_orderkey, l_linenumber, least(l_discount, tax) AS smallest FROM ({_SRC_SQL})")
def q_derive_min(spark, sf_dir):
    """A5: smallest non-null value (nulls skipped)."""
    return _src(spark, sf_dir).select("l_orderkey", "l_linenumber",
                                      derive.derive_min(["l_discount", "tax"]).alias("smallest"))


@register("derive_max",
          f"SELECT l_orderkey, l_linenumber, greatest(l_discount, tax) AS largest FROM ({_SRC_SQL})")
def q_derive_max(spark, sf_dir):
    """A5: largest non-null value (nulls skipped)."""
    return _src(spark, sf_dir).select("l_orderkey", "l_linenumber",
                                      derive.derive_max(["l_discount", "tax"]).alias("largest"))


@register("derive_concat",
          "SELECT l_orderkey, l_linenumber, concat_ws('-', l_returnflag, CAST(nullif(l_linenumber, 1) AS VARCHAR), "
          "l_linestatus) AS code FROM lineitem")
def q_derive_concat(spark, sf_dir):
    """Concatenation with a separator, nulls skipped."""
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     derive.derive_concat([F.col("l_returnflag"), F.nullif(F.col("l_linenumber"), F.lit(1)),
                                           F.col("l_linestatus")], "-").alias("code"))


@register("derive_first_non_null",
          f"SELECT l_orderkey, l_linenumber, coalesce(tax, nullif(l_discount, 0), 0.0) AS first_rate FROM ({_SRC_SQL})")
def q_derive_first_non_null(spark, sf_dir):
    """First non-null value in order."""
    s = _src(spark, sf_dir)
    return s.select("l_orderkey", "l_linenumber",
                    derive.derive_first_non_null([F.col("tax"), F.nullif(F.col("l_discount"), F.lit(0.0)),
                                                  F.lit(0.0)]).alias("first_rate"))


@register("derive_formula",
          "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem")
def q_derive_formula(spark, sf_dir):
    """arithmetic formula over ``val0..val2`` compiled by Spark (no eval)."""
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     derive.derive_formula(["l_extendedprice", "l_discount", "l_tax"],
                                           "val0 * (1 - val1) * (1 + val2)").alias("charge"))


def _multiply(cols, **params):
    out = cols[0]
    for c in cols[1:]:
        out = out * c
    return out


derive.register_calculation("multiply", _multiply)


def _ratio(a, b):
    return a / b.where(b != 0)


derive.register_pandas_calculation("ratio", _ratio, "double")


@register("udf_calculation",
          "SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS product, "
          "l_extendedprice / nullif(l_quantity, 0) AS unit_price FROM lineitem")
def q_udf_calculation(spark, sf_dir):
    """Registered calculations — a Column-level one and a pandas one
    (run Arrow-batched) — used by name like the built-ins."""
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     derive.calculate("custom", ["l_quantity", "l_extendedprice"], function="multiply").alias("product"),
                     derive.calculate("ratio", ["l_extendedprice", "l_quantity"]).alias("unit_price"))
