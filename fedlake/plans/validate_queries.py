"""Validation rules (V-group) and their statistics on whole test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.strings import str_title
from ..operators import validate as V
from ..operators.joins import join_small
from ..session import load
from .catalog import register


def _flat(df, keys):
    """Key columns + violation count + comma-joined rule ids (flat, oracle-comparable)."""
    return df.select(*keys, F.size("violations").alias("n_violations"), V.violation_ids().alias("violation_ids"))


def _ids_sql(*cases):
    """SQL for (n_violations, violation_ids) from (fail_predicate, rule_id) pairs."""
    n = " + ".join(f"CAST(coalesce({p}, true) AS INTEGER)" for p, _ in cases)
    ids = ", ".join(f"CASE WHEN coalesce({p}, true) THEN '{i}' END" for p, i in cases)
    return f"CAST({n} AS INTEGER) AS n_violations, concat_ws(',', {ids}) AS violation_ids"


_BLANK = "({c} IS NULL OR regexp_matches({c}, '^\\s*$'))"


@register("rule_required",
          "SELECT doc_id, " + _ids_sql((_BLANK.format(c="text"), "text:required"),
                                       (_BLANK.format(c="lang"), "lang:required"),
                                       (_BLANK.format(c="source"), "source:required")) + " FROM documents")
def q_rule_required(spark, sf_dir):
    """V1: required = not null and not blank."""
    d = load(spark, sf_dir, "documents")
    rules = [{"field": f, "type": "required"} for f in ("text", "lang", "source")]
    return _flat(V.validate(d, rules), ["doc_id"])


_TYPE_SRC = ("SELECT o_orderkey, o_orderpriority AS prio_text, printf('%.2f', o_totalprice) AS price_text, "
             "strftime(o_orderdate, '%Y-%m-%d') AS date_text, o_orderstatus AS flag_text FROM orders")


@register("rule_type",
          "SELECT o_orderkey, " + _ids_sql(
              ("NOT (prio_text IS NULL OR regexp_matches(trim(prio_text), '^[+-]?\\d+$'))", "prio:integer"),
              ("NOT (price_text IS NULL OR TRY_CAST(trim(price_text) AS DOUBLE) IS NOT NULL)", "price:float"),
              ("NOT (date_text IS NULL OR regexp_matches(trim(date_text), '^\\d{4}-\\d{2}-\\d{2}$'))", "date:date"),
              ("NOT (flag_text IS NULL OR lower(trim(flag_text)) IN ('true','false','1','0','yes','no','y','n',"
               "'t','f'))", "flag:boolean")) + f" FROM ({_TYPE_SRC})")
def q_rule_type(spark, sf_dir):
    """V2: type checks on text columns (integer, float, date, boolean)."""
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("prio_text"),
        F.format_string("%.2f", "o_totalprice").alias("price_text"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"), F.col("o_orderstatus").alias("flag_text"))
    rules = [
        {"field": "prio_text", "type": "type", "params": {"data_type": "integer"}, "id": "prio:integer"},
        {"field": "price_text", "type": "type", "params": {"data_type": "float"}, "id": "price:float"},
        {"field": "date_text", "type": "type", "params": {"data_type": "date"}, "id": "date:date"},
        {"field": "flag_text", "type": "type", "params": {"data_type": "boolean"}, "id": "flag:boolean"},
    ]
    return _flat(V.validate(o, rules), ["o_orderkey"])


@register("rule_pattern",
          "SELECT c_custkey, " + _ids_sql(
              ("NOT regexp_matches(c_name, '[1-9]9$')", "name:search"),
              ("NOT regexp_matches(c_name, '^(?:Customer#0000001)')", "name:match")) + " FROM customer")
def q_rule_pattern(spark, sf_dir):
    """V3: pattern in search mode (anywhere) and match mode (anchored at start)."""
    c = load(spark, sf_dir, "customer")
    rules = [
        {"field": "c_name", "type": "pattern", "params": {"pattern": "[1-9]9$"}, "id": "name:search"},
        {"field": "c_name", "type": "pattern", "params": {"pattern": "Customer#0000001", "mode": "match"},
         "id": "name:match"},
    ]
    return _flat(V.validate(c, rules), ["c_custkey"])


@register("rule_range",
          "SELECT l_orderkey, l_linenumber, " + _ids_sql(
              ("NOT (l_extendedprice BETWEEN 1000 AND 80000)", "price:range"),
              ("NOT (l_discount <= 0.08)", "discount:range"),
              ("NOT (TRY_CAST(l_returnflag AS DOUBLE) >= 0)", "flag:range")) + " FROM lineitem")
def q_rule_range(spark, sf_dir):
    """V4: inclusive numeric range; text that is not a number fails."""
    li = load(spark, sf_dir, "lineitem")
    rules = [
        {"field": "l_extendedprice", "type": "range", "params": {"min": 1000, "max": 80000}, "id": "price:range"},
        {"field": "l_discount", "type": "range", "params": {"max": 0.08}, "id": "discount:range"},
        {"field": "l_returnflag", "type": "range", "params": {"min": 0}, "id": "flag:range"},
    ]
    return _flat(V.validate(li, rules), ["l_orderkey", "l_linenumber"])


@register("rule_length",
          "SELECT p_partkey, " + _ids_sql(
              ("NOT (length(p_name) BETWEEN 5 AND 9)", "name:length"),
              ("NOT (length(p_type) <= 5)", "type:length")) + " FROM part")
def q_rule_length(spark, sf_dir):
    """V5 (+F14): inclusive length bounds."""
    p = load(spark, sf_dir, "part")
    rules = [
        {"field": "p_name", "type": "length", "params": {"min": 5, "max": 9}, "id": "name:length"},
        {"field": "p_type", "type": "length", "params": {"max": 5}, "id": "type:length"},
    ]
    return _flat(V.validate(p, rules), ["p_partkey"])


@register("rule_enum",
          "SELECT o_orderkey, " + _ids_sql(
              ("NOT (o_orderstatus IN ('F', 'O'))", "status:enum"),
              ("NOT (lower(o_orderpriority) IN ('1-urgent', '2-high'))", "prio:enum")) + " FROM orders")
def q_rule_enum(spark, sf_dir):
    """V6: enum membership, case-sensitive and -insensitive."""
    o = load(spark, sf_dir, "orders")
    rules = [
        {"field": "o_orderstatus", "type": "enum", "params": {"values": ["F", "O"]}, "id": "status:enum"},
        {"field": "o_orderpriority", "type": "enum",
         "params": {"values": ["1-URGENT", "2-high"], "case_sensitive": False}, "id": "prio:enum"},
    ]
    return _flat(V.validate(o, rules), ["o_orderkey"])


V.register_validator("title_case", lambda c: c == str_title(c))


@register("rule_custom",
          "SELECT p_partkey, " + _ids_sql(
              ("NOT (p_brand = array_to_string(list_transform(regexp_extract_all(p_brand, '([A-Za-z]+|[^A-Za-z]+)', 1), "
               "lambda s: CASE WHEN regexp_matches(s, '^[A-Za-z]') THEN upper(s[1]) || lower(s[2:]) ELSE s END), ''))",
               "brand:title"),
              ("NOT (p_name = array_to_string(list_transform(regexp_extract_all(p_name, '([A-Za-z]+|[^A-Za-z]+)', 1), "
               "lambda s: CASE WHEN regexp_matches(s, '^[A-Za-z]') THEN upper(s[1]) || lower(s[2:]) ELSE s END), ''))",
               "name:title")) + " FROM part")
def q_rule_custom(spark, sf_dir):
    """V7 + X2: a registered custom validator (text already in title case)."""
    p = load(spark, sf_dir, "part")
    rules = [
        {"field": "p_brand", "type": "custom", "params": {"function": "title_case"}, "id": "brand:title"},
        {"field": "p_name", "type": "custom", "params": {"function": "title_case"}, "id": "name:title"},
    ]
    return _flat(V.validate(p, rules), ["p_partkey"])


@register("rule_compare",
          "SELECT l_orderkey, l_linenumber, " + _ids_sql(
              ("NOT (l_discount IS NULL OR l_tax IS NULL OR l_discount <= l_tax)", "discount<=tax")) + " FROM lineitem")
def q_rule_compare(spark, sf_dir):
    """V8: field-to-field comparison; a null side passes."""
    li = load(spark, sf_dir, "lineitem")
    rules = [{"field": "l_discount", "type": "compare", "params": {"operator": "<=", "compare_to": "l_tax"},
              "id": "discount<=tax"}]
    return _flat(V.validate(li, rules), ["l_orderkey", "l_linenumber"])


@register("rule_date_compare",
          "SELECT l.l_orderkey, l.l_linenumber, " + _ids_sql(
              ("NOT (o.o_orderdate IS NULL OR l.l_shipdate IS NULL OR "
               "CAST(o.o_orderdate AS DATE) < CAST(l.l_shipdate AS DATE))", "order<ship")) +
          " FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey")
def q_rule_date_compare(spark, sf_dir):
    """V9: start date strictly before end date (order date < ship date)."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = join_small(li, o, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    rules = [{"field": "o_orderdate", "type": "date_compare", "params": {"operator": "<", "compare_to": "l_shipdate"},
              "id": "order<ship"}]
    return _flat(V.validate(j, rules), ["l_orderkey", "l_linenumber"])


_PREC_TXT = "regexp_replace(printf('%.4f', l_extendedprice * l_discount), '0+$', '')"


@register("rule_precision",
          f"SELECT l_orderkey, l_linenumber, {_PREC_TXT} AS amount_text, " + _ids_sql(
              (f"NOT ((CASE WHEN contains(trim({_PREC_TXT}), '.') THEN length(split_part(trim({_PREC_TXT}), '.', -1)) "
               "ELSE 0 END) <= 2)", "amount:precision")) + " FROM lineitem")
def q_rule_precision(spark, sf_dir):
    """At most two decimal places in the text."""
    li = load(spark, sf_dir, "lineitem")
    txt = F.regexp_replace(F.format_string("%.4f", F.col("l_extendedprice") * F.col("l_discount")), "0+$", "")
    df = li.select("l_orderkey", "l_linenumber", txt.alias("amount_text"))
    rules = [{"field": "amount_text", "type": "precision", "params": {"max_places": 2}, "id": "amount:precision"}]
    return _flat(V.validate(df, rules), ["l_orderkey", "l_linenumber", "amount_text"])


_EMAIL = ("CASE WHEN c_mktsegment = 'BUILDING' THEN lower(c_mktsegment) || '@' "
          "ELSE lower(replace(c_name, '#', '.')) || '@example.com' END")
_ZIP = "CAST(c_custkey * 104729 AS VARCHAR)"


@register("rule_format",
          f"SELECT c_custkey, {_EMAIL} AS email, {_ZIP} AS zip, " + _ids_sql(
              (f"NOT regexp_matches({_EMAIL}, '^[\\w\\.-]+@[\\w\\.-]+\\.\\w+$')", "email:format"),
              (f"NOT regexp_matches({_ZIP}, '^[0-9]{{5}}(-[0-9]{{4}})?$')", "zip:format")) + " FROM customer")
def q_rule_format(spark, sf_dir):
    """Named format checks (email, zip)."""
    c = load(spark, sf_dir, "customer")
    email = (F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lower("c_mktsegment"), F.lit("@")))
             .otherwise(F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com"))))
    df = c.select("c_custkey", email.alias("email"), (F.col("c_custkey") * 104729).cast("string").alias("zip"))
    rules = [{"field": "email", "type": "format", "params": {"format": "email"}, "id": "email:format"},
             {"field": "zip", "type": "format", "params": {"format": "zip"}, "id": "zip:format"}]
    return _flat(V.validate(df, rules), ["c_custkey", "email", "zip"])


@register("rule_conditional",
          "SELECT o_orderkey, " + _ids_sql(
              ("(o_orderstatus = 'F') AND NOT (o_totalprice <= 300000)", "finished:max")) + " FROM orders")
def q_rule_conditional(spark, sf_dir):
    """A rule applied only where a condition holds."""
    o = load(spark, sf_dir, "orders")
    rules = [{"field": "o_totalprice", "type": "conditional", "id": "finished:max",
              "params": {"when": "o_orderstatus = 'F'", "rule": {"type": "range", "params": {"max": 300000}}}}]
    return _flat(V.validate(o, rules), ["o_orderkey"])


@register("rule_derived",
          "SELECT o_orderkey, " + _ids_sql(
              ("NOT (year(o_orderdate) = year(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH))", "fy:derived")) +
          " FROM orders")
def q_rule_derived(spark, sf_dir):
    """Stored value must equal its derivation (calendar year vs fiscal year)."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate",
                                             F.year("o_orderdate").alias("fiscal_year"))
    rules = [{"field": "fiscal_year", "type": "derived", "id": "fy:derived",
              "params": {"expected": "year(add_months(to_date(o_orderdate), 3))"}}]
    return _flat(V.validate(o, rules), ["o_orderkey"])


@register("rule_severity",
          "SELECT o_orderkey, NOT (o_totalprice > 400000) AS valid_at_error, "
          "NOT (o_totalprice > 400000 OR o_orderpriority = '5-LOW') AS valid_at_warning FROM orders")
def q_rule_severity(spark, sf_dir):
    """Severities, a disabled rule, validity at two thresholds."""
    o = load(spark, sf_dir, "orders")
    rules = [
        {"field": "o_totalprice", "type": "range", "params": {"max": 400000}, "severity": "critical"},
        {"field": "o_orderpriority", "type": "custom", "params": {"function": "not_low"}, "severity": "warning"},
        {"field": "o_orderpriority", "type": "enum", "params": {"values": ["5-LOW"]}, "severity": "info"},
        {"field": "o_orderstatus", "type": "enum", "params": {"values": ["X"]}, "enabled": False},
    ]
    v = V.validate(o, rules)
    return v.select("o_orderkey", V.is_valid(threshold="error").alias("valid_at_error"),
                    V.is_valid(threshold="warning").alias("valid_at_warning"))


V.register_validator("not_low", lambda c: c != F.lit("5-LOW"))

_GROUP_SRC = ("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' "
              "WHEN o_orderstatus = 'O' THEN 'K' || CAST(o_orderkey AS VARCHAR) "
              "ELSE CAST(o_orderkey AS VARCHAR) END AS id_text FROM orders")


@register("rule_groups",
          "SELECT o_orderkey, " + _ids_sql(
              ("(id_text IS NULL OR regexp_matches(id_text, '^\\s*$'))", "id:required"),
              ("NOT (id_text IS NULL OR regexp_matches(id_text, '^\\s*$')) AND NOT regexp_matches(id_text, '^\\d+$')",
               "id:digits")) + f" FROM ({_GROUP_SRC})")
def q_rule_groups(spark, sf_dir):
    """A dependent rule group runs only where its base group passed."""
    o = load(spark, sf_dir, "orders")
    idt = (F.when(F.col("o_orderstatus") == "P", F.lit(""))
           .when(F.col("o_orderstatus") == "O", F.concat(F.lit("K"), F.col("o_orderkey").cast("string")))
           .otherwise(F.col("o_orderkey").cast("string")))
    df = o.select("o_orderkey", idt.alias("id_text"))
    rules = [{"field": "id_text", "type": "required", "group": "base", "id": "id:required"},
             {"field": "id_text", "type": "pattern", "params": {"pattern": "^\\d+$"}, "group": "format",
              "id": "id:digits"}]
    groups = {"base": {}, "format": {"dependencies": ["base"]}}
    return _flat(V.validate(df, rules, groups=groups), ["o_orderkey"])


ORDER_RULES = [
    {"field": "o_orderpriority", "type": "required", "id": "prio:required"},
    {"field": "o_orderpriority", "type": "pattern", "params": {"pattern": "^[1-4]-"}, "severity": "warning",
     "id": "prio:pattern", "message": "Invalid priority for {field}: {value}"},
    {"field": "o_totalprice", "type": "range", "params": {"min": 1000, "max": 450000}, "id": "price:range"},
    {"field": "o_orderstatus", "type": "enum", "params": {"values": ["F", "O"]}, "id": "status:enum",
     "message": "Status {value} of {field} not allowed"},
]

_ENTITY_SQL_BASE = (
    "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, "
    "(o_orderpriority IS NULL OR regexp_matches(o_orderpriority, '^\\s*$')) AS f1, "
    "NOT (o_orderpriority IS NULL OR regexp_matches(o_orderpriority, '^[1-4]-')) AS f2, "
    "NOT (o_totalprice IS NULL OR o_totalprice BETWEEN 1000 AND 450000) AS f3, "
    "NOT (o_orderstatus IS NULL OR o_orderstatus IN ('F', 'O')) AS f4 FROM orders")


@register("validate_entity",
          "SELECT o_orderkey, CAST(f1 AS INTEGER) + CAST(f2 AS INTEGER) + CAST(f3 AS INTEGER) + CAST(f4 AS INTEGER) "
          "AS n_violations, concat_ws(',', CASE WHEN f1 THEN 'prio:required' END, CASE WHEN f2 THEN 'prio:pattern' END,"
          " CASE WHEN f3 THEN 'price:range' END, CASE WHEN f4 THEN 'status:enum' END) AS violation_ids, "
          "concat_ws(' | ', CASE WHEN f2 THEN 'Invalid priority for o_orderpriority: ' || o_orderpriority END, "
          "CASE WHEN f4 THEN 'Status ' || o_orderstatus || ' of o_orderstatus not allowed' END) AS messages "
          f"FROM ({_ENTITY_SQL_BASE})")
def q_validate_entity(spark, sf_dir):
    """V15 + V18: full rule set with message templates."""
    o = load(spark, sf_dir, "orders")
    v = V.validate(o, ORDER_RULES)
    msgs = F.array_join(F.transform(F.filter("violations", lambda x: x["rule_id"].isin("prio:pattern", "status:enum")),
                                    lambda x: x["message"]), " | ")
    return v.select("o_orderkey", F.size("violations").alias("n_violations"),
                    V.violation_ids().alias("violation_ids"), msgs.alias("messages"))


@register("error_policy",
          "SELECT o_orderkey, o_orderstatus, o_totalprice FROM (" + _ENTITY_SQL_BASE + ") "
          "WHERE NOT (f1 OR f3 OR f4)")
def q_error_policy(spark, sf_dir):
    """``skip`` policy keeps rows without error-level violations
    (a warning alone does not reject a row)."""
    o = load(spark, sf_dir, "orders")
    kept = V.apply_error_policy(V.validate(o, ORDER_RULES), "skip")
    return kept.select("o_orderkey", "o_orderstatus", "o_totalprice")


@register("validation_stats",
          "SELECT CAST(count(*) AS BIGINT) AS records, CAST(count(*) FILTER (WHERE NOT (f1 OR f3 OR f4)) AS BIGINT) "
          "AS valid_records, CAST(count(*) FILTER (WHERE f1 OR f3 OR f4) AS BIGINT) AS invalid_records, "
          "CAST(sum(CAST(f1 AS INT) + CAST(f2 AS INT) + CAST(f3 AS INT) + CAST(f4 AS INT)) AS BIGINT) AS violations, "
          "CAST(0 AS BIGINT) AS n_trace, CAST(0 AS BIGINT) AS n_debug, CAST(0 AS BIGINT) AS n_info, "
          "CAST(sum(CAST(f2 AS INT)) AS BIGINT) AS n_warning, "
          "CAST(sum(CAST(f1 AS INT) + CAST(f3 AS INT) + CAST(f4 AS INT)) AS BIGINT) AS n_error, "
          f"CAST(0 AS BIGINT) AS n_critical FROM ({_ENTITY_SQL_BASE})")
def q_validation_stats(spark, sf_dir):
    """Validation totals per severity."""
    o = load(spark, sf_dir, "orders")
    return V.validation_stats(V.validate(o, ORDER_RULES))


@register("violations_by_rule",
          "SELECT field, rule_id, rule_type, severity, CAST(count(*) AS BIGINT) AS n FROM ("
          "SELECT 'o_orderpriority' AS field, 'prio:required' AS rule_id, 'required' AS rule_type, 'error' AS severity "
          f"FROM ({_ENTITY_SQL_BASE}) WHERE f1 UNION ALL "
          "SELECT 'o_orderpriority', 'prio:pattern', 'pattern', 'warning' "
          f"FROM ({_ENTITY_SQL_BASE}) WHERE f2 UNION ALL "
          "SELECT 'o_totalprice', 'price:range', 'range', 'error' "
          f"FROM ({_ENTITY_SQL_BASE}) WHERE f3 UNION ALL "
          "SELECT 'o_orderstatus', 'status:enum', 'enum', 'error' "
          f"FROM ({_ENTITY_SQL_BASE}) WHERE f4) GROUP BY ALL")
def q_violations_by_rule(spark, sf_dir):
    """Violation counts per rule and severity."""
    o = load(spark, sf_dir, "orders")
    return V.violations_by_rule(V.validate(o, ORDER_RULES))


@register("rule_date_range",
          "SELECT o_orderkey, coalesce(CAST(o_orderdate AS DATE) NOT BETWEEN DATE '1994-01-01' AND DATE '1997-12-31', false) "
          "AS out_of_range, CASE WHEN o_orderkey % 5 = 0 THEN true ELSE false END AS bad_text FROM orders")
def q_rule_date_range(spark, sf_dir):
    """dates within bounds, on a date column and on text (text that is no date fails, null passes)."""
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate",
        F.when(F.col("o_orderkey") % 5 == 0, "soon").when(F.col("o_orderkey") % 5 == 1, None)
        .otherwise("1995-05-05").alias("due"))
    out = V.validate(o, [{"field": "o_orderdate", "type": "date_range", "id": "d", "min": "1994-01-01", "max": "1997-12-31"},
                         {"field": "due", "type": "date_range", "id": "t", "min": "1995-01-01"}])
    has = lambda i: F.exists("violations", lambda v: v["rule_id"] == i)
    return out.select("o_orderkey", has("d").alias("out_of_range"), has("t").alias("bad_text"))


@register("rule_conditional_null",
          "SELECT o_orderkey, coalesce(o_orderkey % 4 = 1 AND o_totalprice > 100000, false) AS failed FROM orders")
def q_rule_conditional_null(spark, sf_dir):
    """A condition that is null is not met, so its rule does not apply."""
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.when(F.col("o_orderkey") % 4 < 2, F.col("o_orderkey") % 4).alias("k"))
    out = V.validate(o, [{"field": "o_totalprice", "type": "conditional", "params": {
        "when": "k = 1", "rule": {"type": "range", "params": {"max": 100000}}}}])
    return out.select("o_orderkey", (F.size("violations") > 0).alias("failed"))


@register("config_lost_values",
          "SELECT l_orderkey, l_linenumber, l_linenumber % 3 = 0 AS lost_money, l_linenumber % 3 = 1 AS too_precise, "
          "l_linenumber % 2 = 0 AND l_linenumber % 3 = 2 AS lost_date FROM lineitem")
def q_config_lost_values(spark, sf_dir):
    """V2, V10, V14 from the config: text that cleaning cannot convert, or rounds, is reported, not only nulled; the date
    group is checked only where the amount group passed."""
    import os

    from ..spec import clean_and_validate, load_config
    cfg = load_config(os.path.join(os.path.dirname(__file__), "award_rules.yaml"))
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") % 3 == 0, "n/a").when(F.col("l_linenumber") % 3 == 1, "$1.234").otherwise("$1,234.50")
        .alias("federal_action_obligation"),
        F.when(F.col("l_linenumber") % 2 == 0, "not a date").otherwise("09/30/1999").alias("solicitation_date"))
    out = clean_and_validate(li, cfg)
    has = lambda i: F.exists("violations", lambda v: v["rule_id"] == i)
    return out.select("l_orderkey", "l_linenumber", has("federal_action_obligation:converted").alias("lost_money"),
                      has("federal_action_obligation:numeric.money:precision").alias("too_precise"),
                      has("solicitation_date:converted").alias("lost_date"))


# --- config-driven cleaning + validation (F48 + V15 from field properties) ---------------

_CFG_COLS = ["contract_transaction_unique_key", "federal_action_obligation", "potential_total_value_of_award",
             "current_total_value_of_award", "action_date_fiscal_year", "awarding_agency_code",
             "product_or_service_code", "recipient_state_code", "last_modified_date", "action_date",
             "transaction_description", "award_type"]
_CFG_FAILS = [
    ("NOT (o.o_totalprice IS NULL OR l.l_extendedprice IS NULL OR "
     "o.o_totalprice <= CAST(l.l_extendedprice AS DECIMAL(18,2)))", "current_total_value_of_award:compare"),
    ("CAST(o.o_orderdate AS DATE) > DATE '2000-01-01'", "action_date:date.not_future:not_future"),
    ("NOT regexp_matches(upper(p.p_brand), '^[A-Z0-9]{4}$')", "product_or_service_code:string.psc:pattern"),
    ("NOT regexp_matches(trim(upper(lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0'))), '^[A-Z]{2}$')",
     "recipient_state_code:string.state_code:pattern"),
    ("NOT (trim(upper(l.l_returnflag)) IN ('A', 'B', 'C', 'D'))", "award_type:enum.contract_type:enum"),
    ("NOT (year(CAST(o.o_orderdate AS DATE) + INTERVAL 3 MONTH) BETWEEN 2000 AND 2100)",
     "action_date_fiscal_year:derived.fiscal_year:range"),
]


def _cfg_sql():
    from .award import award_narrow_sql
    base = award_narrow_sql(_CFG_COLS)
    n = " + ".join(f"CAST(coalesce({p}, false) AS INTEGER)" for p, _ in _CFG_FAILS)
    ids = ", ".join(f"CASE WHEN coalesce({p}, false) THEN '{i}' END" for p, i in _CFG_FAILS)
    sel = (f"CONCAT_WS('_', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR)) AS "
           f"contract_transaction_unique_key, CAST(year(CAST(o.o_orderdate AS DATE) + INTERVAL 3 MONTH) AS INTEGER) "
           f"AS action_date_fiscal_year, CAST({n} AS INTEGER) AS n_violations, "
           f"array_to_string(list_sort(list_filter([{ids}], lambda x: x IS NOT NULL)), ',') AS violation_ids")
    return sel, base[base.index(" FROM "):]


_CFG_SEL, _CFG_FROM = _cfg_sql()


@register("config_clean_validate", f"SELECT {_CFG_SEL} {_CFG_FROM}")
def q_config_clean_validate(spark, sf_dir):
    """F48 + V15 + P9 driven by the field-property config: wildcard field
    patterns resolved to the award columns, cleaning operations applied, every
    rule checked (as-of date for "not in the future" is a parameter), the
    fiscal year derived after validation and range-checked."""
    import os

    from ..spec import clean_and_validate, load_config
    from .award import award_narrow
    cfg = load_config(os.path.join(os.path.dirname(__file__), "award_rules.yaml"))
    t = award_narrow(spark, sf_dir, _CFG_COLS)
    out = clean_and_validate(t, cfg, as_of="2000-01-01")
    ids = F.array_join(F.array_sort(F.transform("violations", lambda v: v["rule_id"])), ",")
    return out.select("contract_transaction_unique_key", "action_date_fiscal_year",
                      F.size("violations").alias("n_violations"), ids.alias("violation_ids"))
