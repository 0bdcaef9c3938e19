"""Statistics and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import fiscal_year
from ..operators import metrics
from ..operators import validate as V
from ..operators.mapping import entity_route
from ..session import load
from .catalog import register
from .entities import ENTITIES
from .entity_queries import _MIXED_SQL, _M_AGENCY, _M_CONTRACT, _M_RECIPIENT, _M_TXN, mixed_records
from .validate_queries import _ENTITY_SQL_BASE, ORDER_RULES


@register("processing_stats",
          f"SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE {_M_AGENCY} OR {_M_RECIPIENT} OR "
          f"{_M_CONTRACT} OR {_M_TXN}) AS BIGINT) AS processed, CAST(count(*) FILTER (WHERE NOT ({_M_AGENCY} OR "
          f"{_M_RECIPIENT} OR {_M_CONTRACT} OR {_M_TXN})) AS BIGINT) AS failed FROM ({_MIXED_SQL})")
def q_processing_stats(spark, sf_dir):
    """Total / processed / failed over routed raw records."""
    m = mixed_records(spark, sf_dir)
    return metrics.processing_stats(m.select(entity_route(m, ENTITIES).alias("entity_type")))


@register("last_errors_100",
          f"SELECT o_orderkey, o_orderdate FROM (SELECT f.*, o.o_orderdate FROM ({_ENTITY_SQL_BASE}) f JOIN orders o "
          "USING (o_orderkey) WHERE f1 OR f3 OR f4) ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 100")
def q_last_errors_100(spark, sf_dir):
    """The 100 most recent records that failed validation."""
    v = V.validate(load(spark, sf_dir, "orders"), ORDER_RULES)
    bad = v.where(~V.is_valid()).select("o_orderkey", "o_orderdate")
    return metrics.last_errors(bad, [("o_orderdate", False), ("o_orderkey", True)], 100)


@register("write_success_rate",
          "SELECT o_orderstatus, CAST(count(*) FILTER (WHERE NOT (f1 OR f3 OR f4)) AS BIGINT) AS ok, "
          "CAST(count(*) FILTER (WHERE f1 OR f3 OR f4) AS BIGINT) AS failed, "
          "CAST(floor(count(*) FILTER (WHERE NOT (f1 OR f3 OR f4)) * 100 / count(*)) AS BIGINT) AS success_rate "
          f"FROM ({_ENTITY_SQL_BASE}) GROUP BY o_orderstatus")
def q_write_success_rate(spark, sf_dir):
    """Per batch (order status) written vs rejected and integer success rate."""
    v = V.validate(load(spark, sf_dir, "orders"), ORDER_RULES)
    ok = V.is_valid()
    per = v.groupBy("o_orderstatus").agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"))
    return per.withColumn("success_rate", metrics.success_rate(F.col("ok"), F.col("failed")))


@register("metric_summary",
          "SELECT event_type AS category, json_extract_string(props, '$.k') AS name, min(value) AS min_value, "
          "max(value) AS max_value, round(avg(value), 6) AS avg_value, CAST(count(*) AS BIGINT) AS n FROM events "
          "GROUP BY 1, 2")
def q_metric_summary(spark, sf_dir):
    """A10: min/max/avg per ``category.name`` metric key."""
    e = load(spark, sf_dir, "events")
    keyed = e.select(F.concat_ws(".", "event_type", F.get_json_object("props", "$.k")).alias("metric_key"), "value")
    return metrics.metric_summary(keyed, "metric_key", "value")


_COMPLETE_COLS = {"documents": ["doc_id", "text", "lang", "source", "n_chars"],
                  "labels": ["doc_id", "quality", "toxic"]}


def _completeness_sql():
    parts = []
    for t, cols in _COMPLETE_COLS.items():
        for c in cols:
            parts.append(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", CAST(count(*) AS BIGINT) AS total, "
                         f"CAST(count({c}) AS BIGINT) AS filled, CASE WHEN count(*) > 0 THEN count({c}) * 100.0 / "
                         f"count(*) ELSE 0.0 END AS pct FROM {t}")
    return " UNION ALL ".join(parts)


@register("completeness_report", _completeness_sql())
def q_completeness_report(spark, sf_dir):
    """Filled / total per column, per table, in one pass per table."""
    reps = [metrics.completeness(load(spark, sf_dir, t), t, cols) for t, cols in _COMPLETE_COLS.items()]
    return reps[0].unionByName(reps[1])


@register("completeness_overall",
          f"SELECT \"table\", CASE WHEN sum(total) > 0 THEN sum(filled) * 100.0 / sum(total) ELSE 0.0 END AS pct "
          f"FROM ({_completeness_sql()}) GROUP BY \"table\"")
def q_completeness_overall(spark, sf_dir):
    """Overall filled/total ratio per table (0 when empty)."""
    return metrics.overall_completeness(q_completeness_report(spark, sf_dir))


# The threshold minimums the source's report checks use.
THRESHOLDS = [("validity_pct", 70.0), ("completeness_pct", 80.0), ("routing_pct", 60.0)]

_GATE_METRICS_SQL = (
    f"SELECT 'validity_pct' AS \"check\", count(*) FILTER (WHERE NOT (f1 OR f3 OR f4)) * 100.0 / count(*) AS value "
    f"FROM ({_ENTITY_SQL_BASE}) UNION ALL SELECT 'completeness_pct', (count(text) + count(lang) + count(source)) * "
    "100.0 / (3 * count(*)) FROM documents UNION ALL SELECT 'routing_pct', count(*) FILTER (WHERE "
    f"{_M_AGENCY} OR {_M_RECIPIENT} OR {_M_CONTRACT} OR {_M_TXN}) * 100.0 / count(*) FROM ({_MIXED_SQL})")
_THRESH_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{c}', {m})" for c, m in THRESHOLDS) + \
    ") t(\"check\", minimum)"
_GATE_SQL = (f"SELECT t.\"check\", m.value, CAST(t.minimum AS DOUBLE) AS minimum, coalesce(m.value >= t.minimum, false) "
             f"AS passed FROM ({_THRESH_SQL}) t LEFT JOIN ({_GATE_METRICS_SQL}) m USING (\"check\")")


def _gate_metrics(spark, sf_dir):
    v = V.validate(load(spark, sf_dir, "orders"), ORDER_RULES)
    validity = v.agg((F.count_if(V.is_valid()) * 100.0 / F.count(F.lit(1))).alias("value")) \
        .select(F.lit("validity_pct").alias("check"), "value")
    d = load(spark, sf_dir, "documents")
    comp = d.agg(((F.count("text") + F.count("lang") + F.count("source")) * 100.0 / (3 * F.count(F.lit(1))))
                 .alias("value")).select(F.lit("completeness_pct").alias("check"), "value")
    m = mixed_records(spark, sf_dir)
    routed = m.select(entity_route(m, ENTITIES).alias("t"))
    rout = routed.agg((F.count("t") * 100.0 / F.count(F.lit(1))).alias("value")) \
        .select(F.lit("routing_pct").alias("check"), "value")
    return validity.unionByName(comp).unionByName(rout)


def _thresholds(spark):
    return spark.createDataFrame(THRESHOLDS, "check string, minimum double")


@register("quality_gate", "SELECT *, printf('%s: %.1f (minimum %.1f)', \"check\", coalesce(value, 0.0), minimum) AS message "
                          f"FROM ({_GATE_SQL})")
def q_quality_gate(spark, sf_dir):
    """Data-quality metrics against minimum thresholds (pass flag per check)."""
    return metrics.quality_gate(_gate_metrics(spark, sf_dir), _thresholds(spark))


@register("quality_gate_summary",
          "SELECT CAST(count(*) FILTER (WHERE passed) AS BIGINT) AS passed, CAST(count(*) FILTER (WHERE NOT passed) "
          f"AS BIGINT) AS failed, coalesce(bool_and(passed), true) AS all_passed FROM ({_GATE_SQL})")
def q_quality_gate_summary(spark, sf_dir):
    """Passed / failed totals and all-passed."""
    return metrics.gate_summary(metrics.quality_gate(_gate_metrics(spark, sf_dir), _thresholds(spark)))


@register("daily_history_30",
          "SELECT CAST(ts AS DATE) AS day, first(value ORDER BY ts, event_id) AS value, min(ts) AS first_ts FROM events "
          "WHERE ts IS NOT NULL GROUP BY 1 ORDER BY day DESC LIMIT 30")
def q_daily_history_30(spark, sf_dir):
    """One entry per day (first event wins), the last 30 days."""
    return metrics.daily_history(load(spark, sf_dir, "events"), "ts", "value", 30, tiebreak="event_id")


_FY_SQL = ("SELECT CAST(year(CAST(l.l_shipdate AS DATE) + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_year, "
           "s.s_nationkey AS awarding_sub_agency_code, CAST(sum(CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * "
           "(1 - CAST(l.l_discount AS DECIMAL(18,2))) AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS obligations, "
           "CAST(count(*) AS BIGINT) AS n_transactions, CAST(count(DISTINCT l.l_orderkey) AS BIGINT) AS n_contracts "
           "FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2")


@register("spend_by_fy_org", _FY_SQL)
def q_spend_by_fy_org(spark, sf_dir):
    """Obligations, transactions and distinct contracts by fiscal year and awarding sub-agency."""
    from .award import award_narrow
    t = award_narrow(spark, sf_dir, ["last_modified_date", "awarding_sub_agency_code", "federal_action_obligation",
                                     "award_id_piid"])
    return (t.groupBy(fiscal_year("last_modified_date").alias("fiscal_year"), "awarding_sub_agency_code")
            .agg(F.sum("federal_action_obligation").cast("decimal(38,2)").alias("obligations"),
                 F.count(F.lit(1)).alias("n_transactions"),
                 F.countDistinct("award_id_piid").alias("n_contracts")))


_SCORE_SQL = (
    "WITH g AS (SELECT l_suppkey, count(*) AS n, avg(l_discount) AS d, avg(CASE WHEN l_returnflag = 'R' "
    "THEN 1.0 ELSE 0.0 END) AS r FROM lineitem GROUP BY l_suppkey) SELECT l_suppkey, "
    "round(coalesce(least(n * 0.1, 40.0), 0.0) + coalesce(least(d * 500.0, 30.0), 0.0) + "
    "coalesce(least((1 - r) * 40.0, 30.0), 0.0), 6) AS score, "
    "concat_ws(',', CASE WHEN n < 500 THEN 'few_lines' END, CASE WHEN d > 0.05 THEN 'high_discount' END, "
    "CASE WHEN r > 0.3 THEN 'many_returns' END) AS issues FROM g")


@register("quality_score", f"SELECT *, score < 50 AS low FROM ({_SCORE_SQL})")
def q_quality_score(spark, sf_dir):
    """Capped weighted score per supplier, low-scorer flag and issue labels."""
    li = load(spark, sf_dir, "lineitem")
    g = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.avg("l_discount").alias("d"),
                                    F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)).alias("r"))
    score = metrics.weighted_score([(F.col("n"), 0.1, 40.0), (F.col("d"), 500.0, 30.0),
                                    (1 - F.col("r"), 40.0, 30.0)])
    labels = metrics.issue_labels([(F.col("n") < 500, "few_lines"), (F.col("d") > 0.05, "high_discount"),
                                   (F.col("r") > 0.3, "many_returns")])
    score = F.round(score, 6)  # independent of the order partial averages were merged in
    return g.select("l_suppkey", score.alias("score"), F.array_join(labels, ",").alias("issues"),
                    (score < 50).alias("low"))


@register("quality_score_mean", f"SELECT round(avg(score), 6) AS mean_score, CAST(count(*) FILTER (WHERE score < 50) "
                                f"AS BIGINT) AS n_low FROM ({_SCORE_SQL})")
def q_quality_score_mean(spark, sf_dir):
    """Overall mean score and number of low scorers."""
    s = q_quality_score(spark, sf_dir)
    return s.agg(F.round(F.avg("score"), 6).alias("mean_score"), F.count_if("low").alias("n_low"))


_GAP_SQL = ("SELECT 'part_never_ordered' AS kind, p_partkey AS key FROM part WHERE p_partkey NOT IN "
            "(SELECT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL) UNION ALL "
            "SELECT 'customer_without_orders', c_custkey FROM customer WHERE c_custkey NOT IN "
            "(SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")


def _gaps(spark, sf_dir):
    p, li = load(spark, sf_dir, "part"), load(spark, sf_dir, "lineitem")
    c, o = load(spark, sf_dir, "customer"), load(spark, sf_dir, "orders")
    return metrics.gap_report(p, li, F.col("p_partkey"), F.col("l_partkey"), "part_never_ordered").unionByName(
        metrics.gap_report(c, o, F.col("c_custkey"), F.col("o_custkey"), "customer_without_orders"))


@register("gap_report", _GAP_SQL)
def q_gap_report(spark, sf_dir):
    """Items without a counterpart (parts never ordered, customers without orders)."""
    return _gaps(spark, sf_dir)


@register("issue_list",
          "SELECT 'gap' AS issue_type, kind || ':' || CAST(key AS VARCHAR) AS subject, 'medium' AS priority, "
          f"'add coverage for ' || kind AS recommendation FROM ({_GAP_SQL}) UNION ALL SELECT 'check', \"check\", "
          f"'high', 'raise ' || \"check\" || ' above ' || CAST(minimum AS VARCHAR) FROM ({_GATE_SQL}) WHERE NOT passed")
def q_issue_list(spark, sf_dir):
    """Gaps and failed quality checks as one prioritised issue list."""
    gate = metrics.quality_gate(_gate_metrics(spark, sf_dir), _thresholds(spark))
    return metrics.issue_list(_gaps(spark, sf_dir), gate)
