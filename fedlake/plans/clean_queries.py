"""Scalar cleaning functions (F-group) applied to whole test tables.

Inputs are real columns of the driver tables; where a function needs text in
a particular shape (money text, dates as text, boolean tokens) the query
first renders the table's own values into that shape, then runs the
library's function on every row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes, dates, numbers, strings
from ..operators import derive
from ..session import load
from .catalog import register

# --- strings --------------------------------------------------------------------


@register("str_trim",
          "SELECT doc_id, regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') AS text_trimmed, "
          "CAST(length(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '')) AS INTEGER) AS trimmed_len "
          "FROM documents")
def q_str_trim(spark, sf_dir):
    """strip all leading/trailing whitespace from every document text."""
    d = load(spark, sf_dir, "documents")
    t = strings.str_trim("text")
    return d.select("doc_id", t.alias("text_trimmed"), F.length(t).alias("trimmed_len"))


@register("str_case",
          "SELECT p_partkey, upper(p_name) AS name_upper, lower(p_brand) AS brand_lower FROM part")
def q_str_case(spark, sf_dir):
    """upper / lower case."""
    p = load(spark, sf_dir, "part")
    return p.select("p_partkey", strings.str_upper("p_name").alias("name_upper"),
                    strings.str_lower("p_brand").alias("brand_lower"))


_TITLE_SQL = ("array_to_string(list_transform(regexp_extract_all({c}, '([A-Za-z]+|[^A-Za-z]+)', 1), "
              "lambda s: CASE WHEN regexp_matches(s, '^[A-Za-z]') THEN upper(s[1]) || lower(s[2:]) ELSE s END), '')")


@register("str_title",
          "SELECT p_partkey, " + _TITLE_SQL.format(c="p_name || '-' || p_type || ' ' || p_brand") +
          " AS title FROM part")
def q_str_title(spark, sf_dir):
    """Python-style title case (capital after any non-letter, e.g. ``Brand#2``, ``x-Y``)."""
    p = load(spark, sf_dir, "part")
    src = F.concat_ws(" ", F.concat_ws("-", "p_name", "p_type"), "p_brand")
    return p.select("p_partkey", strings.str_title(src).alias("title"))


@register("str_pad",
          "SELECT s_suppkey, CASE WHEN length(CAST(s_nationkey AS VARCHAR)) < 3 "
          "THEN lpad(CAST(s_nationkey AS VARCHAR), 3, '0') ELSE CAST(s_nationkey AS VARCHAR) END AS agency_code, "
          "CASE WHEN length(CAST(s_suppkey AS VARCHAR)) < 2 THEN rpad(CAST(s_suppkey AS VARCHAR), 2, '*') "
          "ELSE CAST(s_suppkey AS VARCHAR) END AS padded_right FROM supplier")
def q_str_pad(spark, sf_dir):
    """pad left/right to a length; longer values are never truncated."""
    s = load(spark, sf_dir, "supplier")
    return s.select("s_suppkey", strings.str_pad(F.col("s_nationkey"), 3, "0", "left").alias("agency_code"),
                    strings.str_pad(F.col("s_suppkey"), 2, "*", "right").alias("padded_right"))


@register("str_match",
          "SELECT p_partkey, CASE WHEN regexp_matches(p_name, '^(?:red|blue)') THEN p_name END AS matched FROM part")
def q_str_match(spark, sf_dir):
    """prefix pattern match; non-matching values become null."""
    p = load(spark, sf_dir, "part")
    return p.select("p_partkey", strings.str_match("p_name", "red|blue").alias("matched"))


@register("str_strip_chars",
          "SELECT c_custkey, replace(replace(c_name, '#', ''), '0', '') AS stripped FROM customer")
def q_str_strip_chars(spark, sf_dir):
    """delete given characters anywhere."""
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", strings.str_strip_chars("c_name", "#0").alias("stripped"))


@register("str_extract",
          "SELECT c_custkey, nullif(regexp_extract(c_name, '[1-9][0-9]{2}', 0), '') AS extracted FROM customer")
def q_str_extract(spark, sf_dir):
    """first match of a pattern or null."""
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", strings.str_extract("c_name", "[1-9][0-9]{2}").alias("extracted"))


@register("str_truncate",
          "SELECT doc_id, substring(text, 1, 4000) AS text_4000, CAST(length(substring(text, 1, 4000)) AS INTEGER) AS len "
          "FROM documents")
def q_str_truncate(spark, sf_dir):
    """F8: truncate every document to 4000 characters (description rule)."""
    d = load(spark, sf_dir, "documents")
    t = strings.str_truncate("text", 4000)
    return d.select("doc_id", t.alias("text_4000"), F.length(t).alias("len"))


@register("str_regex_replace",
          "SELECT c_custkey, regexp_replace(c_name, '[0-9]+', '<n>', 'g') AS replaced FROM customer")
def q_str_regex_replace(spark, sf_dir):
    """regex replace (all matches)."""
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", strings.str_regex_replace("c_name", "[0-9]+", "<n>").alias("replaced"))


@register("str_format",
          "SELECT c_custkey, printf('Recipient %s (100%%)', CAST(c_custkey AS VARCHAR)) AS formatted FROM customer")
def q_str_format(spark, sf_dir):
    """format a template with the value."""
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", strings.str_format("c_custkey", "Recipient {value} (100%)").alias("formatted"))


@register("map_values",
          "SELECT c_custkey, coalesce(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AUTO' "
          "WHEN 'MACHINERY' THEN 'MACH' END, c_mktsegment) AS segment FROM customer")
def q_map_values(spark, sf_dir):
    """map listed values, pass the rest through."""
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", strings.map_values("c_mktsegment", {"AUTOMOBILE": "AUTO", "MACHINERY": "MACH"})
                    .alias("segment"))


_ZIP_IN = "CAST(o_orderkey * 104729 AS VARCHAR)"
_ZIP_DIGITS = f"regexp_replace({_ZIP_IN}, '[^0-9]', '', 'g')"


@register("norm_zip",
          f"SELECT o_orderkey, {_ZIP_IN} AS zip_raw, CASE WHEN length({_ZIP_DIGITS}) = 9 THEN "
          f"substring({_ZIP_DIGITS}, 1, 5) || '-' || substring({_ZIP_DIGITS}, 6, 4) "
          f"WHEN length({_ZIP_DIGITS}) BETWEEN 1 AND 5 THEN lpad({_ZIP_DIGITS}, 5, '0') END AS zip, "
          f"substring(CASE WHEN length({_ZIP_IN}) < 5 THEN lpad({_ZIP_IN}, 5, '0') ELSE {_ZIP_IN} END, 1, 5) "
          "AS zip5 FROM orders")
def q_norm_zip(spark, sf_dir):
    """ZIP normalisation, both modes, over order-derived digit strings."""
    o = load(spark, sf_dir, "orders")
    raw = (F.col("o_orderkey") * 104729).cast("string")
    return o.select("o_orderkey", raw.alias("zip_raw"), strings.norm_zip(raw).alias("zip"),
                    strings.norm_zip(raw, "zip5").alias("zip5"))


@register("norm_codes",
          "SELECT c.c_custkey, "
          "CASE WHEN length(trim(CAST(c.c_nationkey AS VARCHAR))) < 3 THEN lpad(trim(CAST(c.c_nationkey AS VARCHAR)), 3, "
          "'0') ELSE trim(CAST(c.c_nationkey AS VARCHAR)) END AS agency_code, "
          "upper(c.c_name) AS uei, "
          "nullif(regexp_extract(replace(replace(replace(replace(replace(printf('(%03d) %03d-%04d', "
          "c.c_nationkey + 200, c.c_custkey % 1000, c.c_custkey), '(', ''), ')', ''), '-', ''), ' ', ''), '.', ''), "
          "'[0-9]{10}', 0), '') AS phone, "
          "regexp_replace(regexp_replace(upper(substring(n.n_name, 1, 2)), '^\\s+', ''), '\\s+$', '') AS state, "
          "coalesce(CASE regexp_replace(regexp_replace(upper(CASE WHEN c.c_nationkey < 3 THEN 'u.s.' ELSE n.n_name END), "
          "'^\\s+', ''), '\\s+$', '') WHEN 'US' THEN 'USA' WHEN 'U.S.' THEN 'USA' WHEN 'U.S.A.' THEN 'USA' "
          "WHEN 'United States' THEN 'USA' END, regexp_replace(regexp_replace(upper(CASE WHEN c.c_nationkey < 3 "
          "THEN 'u.s.' ELSE n.n_name END), '^\\s+', ''), '\\s+$', '')) AS country "
          "FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey")
def q_norm_codes(spark, sf_dir):
    """standard code chains (agency code, UEI, phone, state, country)."""
    from ..operators.joins import join_small
    c = load(spark, sf_dir, "customer")
    n = load(spark, sf_dir, "nation").select(F.col("n_nationkey"), F.col("n_name"))
    j = join_small(c, n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    phone_text = F.format_string("(%03d) %03d-%04d", F.col("c_nationkey") + 200, F.col("c_custkey") % 1000,
                                 F.col("c_custkey"))
    country_text = F.when(F.col("c_nationkey") < 3, F.lit("u.s.")).otherwise(F.col("n_name"))
    return j.select("c_custkey",
                    strings.norm_code(F.col("c_nationkey"), "agency_code").alias("agency_code"),
                    strings.norm_code("c_name", "uei").alias("uei"),
                    strings.norm_code(phone_text, "phone").alias("phone"),
                    strings.norm_code(F.substring("n_name", 1, 2), "state").alias("state"),
                    strings.norm_code(country_text, "country").alias("country"))


# --- numbers ----------------------------------------------------------------------

@register("num_parse",
          "SELECT o_orderkey, TRY_CAST(trim(printf('%.2f', o_totalprice)) AS DOUBLE) AS price, "
          "TRY_CAST(trim(o_orderpriority) AS DOUBLE) AS priority_num FROM orders")
def q_num_parse(spark, sf_dir):
    """text -> number; unparseable text (``1-URGENT``) -> null."""
    o = load(spark, sf_dir, "orders")
    return o.select("o_orderkey", numbers.num_parse(F.format_string("%.2f", "o_totalprice")).alias("price"),
                    numbers.num_parse("o_orderpriority").alias("priority_num"))


@register("num_int",
          "SELECT l_orderkey, l_linenumber, "
          "CAST(trunc(TRY_CAST(printf('%.2f', l_extendedprice - 50000) AS DOUBLE)) AS BIGINT) AS int_value "
          "FROM lineitem")
def q_num_int(spark, sf_dir):
    """integer via float, truncating toward zero (negatives included)."""
    li = load(spark, sf_dir, "lineitem")
    txt = F.format_string("%.2f", F.col("l_extendedprice") - 50000)
    return li.select("l_orderkey", "l_linenumber", numbers.num_int(txt).alias("int_value"))


@register("num_decimal",
          "SELECT l_orderkey, l_linenumber, TRY_CAST(printf('%.4f', l_extendedprice * l_discount) AS DECIMAL(18,2)) "
          "AS discount_amount FROM lineitem")
def q_num_decimal(spark, sf_dir):
    """text with 4 places -> decimal(18,2) (half-up on the text)."""
    li = load(spark, sf_dir, "lineitem")
    txt = F.format_string("%.4f", F.col("l_extendedprice") * F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", numbers.num_decimal(txt).alias("discount_amount"))


@register("num_round_clamp",
          "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN v < 1000 THEN 1000 WHEN v > 50000 THEN 50000 ELSE v END "
          "AS DOUBLE) AS clamped, CAST(trunc(round_even(TRY_CAST(printf('%.3f', l_extendedprice / 7) "
          "AS DECIMAL(38,10)), 0)) AS BIGINT) AS as_int "
          "FROM (SELECT *, round_even(TRY_CAST(printf('%.3f', l_extendedprice / 7) AS DECIMAL(38,10)), 1) AS v "
          "FROM lineitem)")
def q_num_round_clamp(spark, sf_dir):
    """half-even rounding on decimals, clamp to [1000, 50000], integer form."""
    li = load(spark, sf_dir, "lineitem")
    txt = F.format_string("%.3f", F.col("l_extendedprice") / 7)
    return li.select("l_orderkey", "l_linenumber",
                     numbers.num_round_clamp(txt, 1, 1000, 50000).alias("clamped"),
                     numbers.num_round_clamp(txt, 0, integer=True).alias("as_int"))


_MONEY_TXT = "'$' || format('{:,.2f}', o_totalprice - 200000)"


@register("money_parse",
          f"SELECT o_orderkey, {_MONEY_TXT} AS money_text, "
          f"TRY_CAST(trim(replace(replace({_MONEY_TXT}, '$', ''), ',', '')) AS DECIMAL(18,2)) AS amount, "
          "TRY_CAST(trim(replace(replace(o_orderpriority, '$', ''), ',', '')) AS DECIMAL(18,2)) AS bad_amount "
          "FROM orders")
def q_money_parse(spark, sf_dir):
    """F24 (with F27 to render): ``$-1,234.50`` -> decimal; the point is kept."""
    o = load(spark, sf_dir, "orders")
    txt = numbers.fmt_currency(F.col("o_totalprice") - 200000)
    return o.select("o_orderkey", txt.alias("money_text"), numbers.money_parse(txt).alias("amount"),
                    numbers.money_parse("o_orderpriority").alias("bad_amount"))


@register("money_valid",
          "SELECT o_orderkey, regexp_matches(t, '^-?\\$?\\s*\\d+(?:,\\d{3})*(?:\\.\\d{2})?$') AND "
          "TRY_CAST(trim(replace(replace(t, '$', ''), ',', '')) AS DECIMAL(18,2)) IS NOT NULL AS valid_money "
          "FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '$' || format('{:,.2f}', o_totalprice) "
          "WHEN o_orderstatus = 'O' THEN printf('%.3f', o_totalprice) ELSE '-' || printf('%.2f', o_totalprice) "
          "END AS t FROM orders)")
def q_money_valid(spark, sf_dir):
    """money text validity over three renderings of order totals."""
    o = load(spark, sf_dir, "orders")
    t = (F.when(F.col("o_orderstatus") == "F", numbers.fmt_currency("o_totalprice"))
         .when(F.col("o_orderstatus") == "O", F.format_string("%.3f", "o_totalprice"))
         .otherwise(F.concat(F.lit("-"), F.format_string("%.2f", "o_totalprice"))))
    return o.select("o_orderkey", numbers.money_valid(t).alias("valid_money"))


@register("percent_parse",
          "SELECT l_orderkey, l_linenumber, TRY_CAST(trim(replace(printf('%.1f%%', l_discount * 100), '%', '')) "
          "AS DECIMAL(10,3)) AS discount_pct FROM lineitem")
def q_percent_parse(spark, sf_dir):
    """``7.0%`` -> decimal(10,3)."""
    li = load(spark, sf_dir, "lineitem")
    txt = F.format_string("%.1f%%", F.col("l_discount") * 100)
    return li.select("l_orderkey", "l_linenumber", numbers.percent_parse(txt).alias("discount_pct"))


@register("fmt_currency",
          "SELECT l_orderkey, l_linenumber, '$' || format('{:,.2f}', l_extendedprice) AS value_text FROM lineitem")
def q_fmt_currency(spark, sf_dir):
    """``$#,##0.00``."""
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", numbers.fmt_currency("l_extendedprice").alias("value_text"))


# --- dates ----------------------------------------------------------------------------

_STRIP = "regexp_replace({c}, '[ T]\\d{{1,2}}:\\d{{2}}(:\\d{{2}}(\\.\\d+)?)?$', '')"


def _parse_sql(c):
    s = "trim(" + _STRIP.format(c=c) + ")"
    return (f"CAST(coalesce(try_strptime({s}, '%m/%d/%Y'), try_strptime({s}, '%Y%m%d'), "
            f"try_strptime({s}, '%Y-%m-%d')) AS DATE)")


@register("date_parse_multi",
          "SELECT o_orderkey, " + _parse_sql("strftime(o_orderdate, '%m/%d/%Y')") + " AS d_us, "
          + _parse_sql("strftime(o_orderdate, '%Y%m%d')") + " AS d_compact, "
          + _parse_sql("strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')") + " AS d_iso_time, "
          + _parse_sql("o_orderpriority") + " AS d_bad FROM orders")
def q_date_parse_multi(spark, sf_dir):
    """F30 + F31: dates rendered in three formats parsed back by the format list; junk -> null."""
    o = load(spark, sf_dir, "orders")
    fmts = ("%m/%d/%Y", "%Y%m%d", "%Y-%m-%d")
    return o.select(
        "o_orderkey",
        dates.date_parse_multi(F.date_format("o_orderdate", "MM/dd/yyyy"), fmts).alias("d_us"),
        dates.date_parse_multi(F.date_format("o_orderdate", "yyyyMMdd"), fmts).alias("d_compact"),
        dates.date_parse_multi(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), fmts).alias("d_iso_time"),
        dates.date_parse_multi("o_orderpriority", fmts).alias("d_bad"))


@register("date_strip_time",
          "SELECT event_id, " + _STRIP.format(c="strftime(ts, '%Y-%m-%d %H:%M:%S')") + " AS day_text FROM events")
def q_date_strip_time(spark, sf_dir):
    """drop the time part of timestamp text."""
    e = load(spark, sf_dir, "events")
    return e.select("event_id", dates.date_strip_time(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("day_text"))


@register("date_shift_format",
          "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY, '%d.%m.%Y') AS due_text "
          "FROM orders")
def q_date_shift_format(spark, sf_dir):
    """F32: parse, add 30 days, re-format as ``dd.mm.yyyy``."""
    o = load(spark, sf_dir, "orders")
    return o.select("o_orderkey", dates.date_shift_format(F.date_format("o_orderdate", "yyyy-MM-dd"), 30,
                                                          ("%Y-%m-%d",), "%d.%m.%Y").alias("due_text"))


@register("date_not_future",
          "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) <= DATE '2000-01-01' AS not_future FROM lineitem")
def q_date_not_future(spark, sf_dir):
    """not after an as-of date (a parameter, not the wall clock)."""
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", dates.date_not_future("l_shipdate", "2000-01-01")
                     .alias("not_future"))


@register("fiscal_year",
          "SELECT o_orderkey, CAST(year(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH) AS INTEGER) AS fy_oct, "
          "CAST(year(CAST(o_orderdate AS DATE) + INTERVAL 9 MONTH) AS INTEGER) AS fy_apr, "
          "CAST(year(o_orderdate) AS INTEGER) AS fy_jan FROM orders")
def q_fiscal_year(spark, sf_dir):
    """fiscal year for start months 10, 4 and 1."""
    o = load(spark, sf_dir, "orders")
    return o.select("o_orderkey", dates.fiscal_year("o_orderdate", 10).alias("fy_oct"),
                    dates.fiscal_year("o_orderdate", 4).alias("fy_apr"),
                    dates.fiscal_year("o_orderdate", 1).alias("fy_jan"))


@register("fmt_date", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def q_fmt_date(spark, sf_dir):
    """ISO date text."""
    e = load(spark, sf_dir, "events")
    return e.select("event_id", dates.fmt_date("ts").alias("day"))


# --- booleans, enums, codes, collections -----------------------------------------------------

# stand-in tokens: each line picks a token by its part key
_TOKENS = ["true", "1", "yes", "Y", "t", "FALSE", "0", "No", "n", "f", "maybe", "YES, WITHOUT EXCEPTION", " y "]
_TOK_SQL = "(" + "[" + ", ".join("'" + t + "'" for t in _TOKENS) + f"])[(l_partkey % {len(_TOKENS)}) + 1]"


def _token_col():
    return F.element_at(F.array(*[F.lit(t) for t in _TOKENS]), (F.col("l_partkey") % len(_TOKENS) + 1).cast("int"))


@register("bool_parse",
          f"SELECT l_orderkey, l_linenumber, CASE WHEN lower(tok) IN ('true','1','yes','y','t') THEN true "
          f"WHEN lower(tok) IN ('false','0','no','n','f') THEN false END AS flag "
          f"FROM (SELECT *, {_TOK_SQL} AS tok FROM lineitem)")
def q_bool_parse(spark, sf_dir):
    """boolean tokens -> boolean, unknown -> null."""
    li = load(spark, sf_dir, "lineitem").withColumn("tok", _token_col())
    return li.select("l_orderkey", "l_linenumber", codes.bool_parse("tok").alias("flag"))


@register("bool_normalize",
          f"SELECT l_orderkey, l_linenumber, CASE WHEN upper(trim(tok)) IN ('Y','YES','1','TRUE','T',"
          f"'YES, WITHOUT EXCEPTION') THEN 'true' WHEN upper(trim(tok)) IN ('N','NO','0','FALSE','F') THEN 'false' "
          f"END AS flag_text FROM (SELECT *, {_TOK_SQL} AS tok FROM lineitem)")
def q_bool_normalize(spark, sf_dir):
    """tokens -> ``"true"``/``"false"`` text."""
    li = load(spark, sf_dir, "lineitem").withColumn("tok", _token_col())
    return li.select("l_orderkey", "l_linenumber", codes.bool_normalize("tok").alias("flag_text"))


@register("enum_member",
          "SELECT c_custkey, CASE WHEN lower(c_mktsegment) IN ('automobile', 'building') THEN c_mktsegment END "
          "AS segment FROM customer")
def q_enum_member(spark, sf_dir):
    """original text when it is an allowed value (case-insensitive)."""
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", codes.enum_member("c_mktsegment", ["Automobile", "BUILDING"]).alias("segment"))


@register("enum_map",
          "SELECT o_orderkey, coalesce(CASE upper(o_orderpriority) WHEN '1-URGENT' THEN 'P1' WHEN '2-HIGH' THEN 'P2' "
          "END, 'OTHER') AS priority_code FROM orders")
def q_enum_map(spark, sf_dir):
    """case-insensitive translate with a default."""
    o = load(spark, sf_dir, "orders")
    return o.select("o_orderkey", codes.enum_map("o_orderpriority", {"1-urgent": "P1", "2-HIGH": "P2"},
                                                 default="OTHER").alias("priority_code"))


def _decode_sql(table, c):
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in codes.CODE_TABLES[table].items())
    return f"CASE upper(trim({c})) {cases} END"


@register("code_decode",
          f"SELECT l_orderkey, l_linenumber, {_decode_sql('action_type', 'l_returnflag')} AS action_type, "
          f"{_decode_sql('contract_type', 'l_returnflag')} AS contract_type, "
          f"{_decode_sql('yes_no_extended', 'l_linestatus')} AS yes_no FROM lineitem")
def q_code_decode(spark, sf_dir):
    """code -> label decode tables."""
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     codes.code_decode("l_returnflag", "action_type").alias("action_type"),
                     codes.code_decode("l_returnflag", "contract_type").alias("contract_type"),
                     codes.code_decode("l_linestatus", "yes_no_extended").alias("yes_no"))


@register("array_clean",
          "SELECT p_partkey, CASE WHEN len(a) BETWEEN 2 AND 3 AND list_bool_and(list_transform(a, "
          "lambda x: length(x) >= 3)) THEN array_to_string(a, '|') END AS words, "
          "CASE WHEN len(a) BETWEEN 2 AND 3 AND list_bool_and(list_transform(a, lambda x: length(x) >= 3)) "
          "THEN CAST(len(a) AS INTEGER) END AS n_words FROM (SELECT p_partkey, list_filter(list_transform(string_split(p_name || ' ' "
          "|| p_type, ' '), lambda x: nullif(upper(x), '')), lambda x: x IS NOT NULL) AS a FROM part)")
def q_array_clean(spark, sf_dir):
    """transform items, drop nulls, size bounds and per-item validity."""
    p = load(spark, sf_dir, "part")
    arr = codes.array_clean(F.split(F.concat_ws(" ", "p_name", "p_type"), " "),
                            item=lambda x: F.nullif(F.upper(x), F.lit("")), min_size=2, max_size=3,
                            item_valid=lambda x: F.length(x) >= 3)
    return p.select("p_partkey", F.array_join(arr, "|").alias("words"), F.size(arr).alias("n_words")) \
        .withColumn("n_words", F.when(F.col("words").isNotNull(), F.col("n_words")))


@register("composite_chain",
          "SELECT c_custkey, CASE WHEN length(upper(trim(c_mktsegment))) < 12 "
          "THEN rpad(upper(trim(c_mktsegment)), 12, '.') ELSE upper(trim(c_mktsegment)) END AS chained FROM customer")
def q_composite_chain(spark, sf_dir):
    """trim -> upper -> pad, stopping at null."""
    c = load(spark, sf_dir, "customer")
    chain = [strings.str_trim, strings.str_upper, lambda x: strings.str_pad(x, 12, ".", "right")]
    return c.select("c_custkey", codes.composite_chain("c_mktsegment", chain).alias("chained"))


@register("transform_keep_on_error",
          "SELECT o_orderkey, coalesce(CAST(TRY_CAST(o_orderpriority AS BIGINT) AS VARCHAR), o_orderpriority) AS "
          "priority_int, CAST(o_orderkey AS VARCHAR) AS key_int FROM orders")
def q_transform_keep_on_error(spark, sf_dir):
    """best-effort cast; a failed cast keeps the original value."""
    o = load(spark, sf_dir, "orders")
    return o.select("o_orderkey", derive.transform_keep_on_error("o_orderpriority", "integer").alias("priority_int"),
                    derive.transform_keep_on_error("o_orderkey", "integer").alias("key_int"))


@register("transform_rules",
          "SELECT o_orderkey, upper(trim(o_orderstatus)) AS o_orderstatus, "
          "TRY_CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, "
          "CASE WHEN length(CAST(o_custkey AS VARCHAR)) < 6 THEN lpad(CAST(o_custkey AS VARCHAR), 6, '0') "
          "ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey FROM orders")
def q_transform_rules(spark, sf_dir):
    """a rule list applied to a table, field by field, in one projection."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    rules = [
        {"field": "o_orderstatus", "ops": [{"type": "trim"}, {"type": "uppercase"}]},
        {"field": "o_totalprice", "ops": [{"type": "convert_to_decimal"}]},
        {"field": "o_custkey", "ops": [{"type": "pad_left", "length": 6, "character": "0"}]},
    ]
    return derive.transform_rules(o, rules)
