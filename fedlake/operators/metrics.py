"""Processing statistics, completeness, quality gates and reports.

All aggregates are grouped aggregations with map-side partial aggregation;
the only ordered limits are the report features themselves (last N errors,
last 30 days).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def processing_stats(routed: DataFrame, type_col: str = "entity_type",
                     errors_col: str | None = None) -> DataFrame:
    """One row: total, processed (routed), failed (not routed), error count."""
    aggs = [F.count(F.lit(1)).alias("total"),
            F.count_if(F.col(type_col).isNotNull()).alias("processed"),
            F.count_if(F.col(type_col).isNull()).alias("failed")]
    if errors_col:
        aggs.append(F.sum(F.size(errors_col)).cast("bigint").alias("errors"))
    return routed.agg(*aggs)


def last_errors(df: DataFrame, order: Sequence[tuple[str, bool]], n: int = 100) -> DataFrame:
    """The most recent ``n`` error rows (a top-n report, TakeOrderedAndProject)."""
    return df.orderBy(*[F.col(c).desc_nulls_last() if not asc else F.col(c).asc_nulls_last()
                        for c, asc in order]).limit(n)


def success_rate(ok: Column, failed: Column) -> Column:
    """Integer percentage ``ok*100 // (ok+failed)``; null when nothing was written."""
    total = ok + failed
    return F.when(total > 0, F.floor(ok * 100 / total)).cast("bigint")


def metric_summary(df: DataFrame, key: str, value: str, digits: int = 6) -> DataFrame:
    """A10: min / max / avg / count per metric, key ``category.name`` split at
    the first dot. The mean is rounded to ``digits`` places so it does not
    depend on the order partial sums were combined in."""
    cat = F.substring_index(F.col(key), ".", 1)
    name = F.when(F.col(key).contains("."), F.expr(f"substring({key}, instr({key}, '.') + 1)"))
    return (df.select(cat.alias("category"), name.alias("name"), F.col(value).alias("v"))
            .groupBy("category", "name")
            .agg(F.min("v").alias("min_value"), F.max("v").alias("max_value"), F.avg("v").alias("avg_value"),
                 F.count(F.lit(1)).alias("n")))


def completeness(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column ``(table, column, total, filled, pct)`` from one aggregation
    pass, unpivoted; ``pct`` is 0 for an empty table."""
    cols = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("__total"),
                    *[F.count(F.col(f"`{c}`")).alias(f"__f{i}") for i, c in enumerate(cols)])
    stacked = counts.select("__total", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"__f{i}").alias("filled")) for i, c in enumerate(cols)])).alias("s"))
    return stacked.select(F.lit(table).alias("table"), "s.column", F.col("__total").alias("total"),
                          F.col("s.filled").alias("filled"),
                          F.when(F.col("__total") > 0, F.col("s.filled") * 100.0 / F.col("__total"))
                          .otherwise(F.lit(0.0)).alias("pct"))


def is_key(df: DataFrame, column: str, hashed: Callable[[Column], Column] = F.xxhash64) -> bool:
    """No null and no value twice in ``column``, exactly, though only hashes of its values are exchanged.

    Hashes that all differ prove it. Else the rows of one repeated hash are compared by value, which refutes it unless
    those values merely collide; only then are the rows of all repeated hashes compared. No row: true."""
    c = F.col(f"`{column}`")
    if not df.where(c.isNull()).isEmpty():
        return False
    again = df.select(hashed(c).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    one = again.agg(F.min("_hash")).first()[0]
    if one is None:
        return True

    def differ(rows):
        return rows.groupBy(c).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty()

    return differ(df.where(hashed(c) == one)) and differ(
        df.select(c).join(again, hashed(c) == F.col("_hash"), "left_semi"))


def overall_completeness(report: DataFrame) -> DataFrame:
    """Overall covered/total ratio per table (0 when empty)."""
    return (report.groupBy("table").agg(F.sum("filled").alias("filled"), F.sum("total").alias("total"))
            .select("table", F.when(F.col("total") > 0, F.col("filled") * 100.0 / F.col("total"))
                    .otherwise(F.lit(0.0)).alias("pct")))


def quality_gate(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Metrics ``(check, value)`` against thresholds ``(check, minimum)``:
    pass flag and message per check (a missing metric fails)."""
    j = thresholds.join(metrics, "check", "left")
    passed = F.coalesce(F.col("value") >= F.col("minimum"), F.lit(False))
    msg = F.format_string("%s: %.1f (minimum %.1f)", F.col("check"), F.coalesce("value", F.lit(0.0)),
                          F.col("minimum"))
    return j.select("check", "value", "minimum", passed.alias("passed"), msg.alias("message"))


def gate_summary(gate: DataFrame) -> DataFrame:
    """Passed / failed totals and the all-passed flag."""
    return gate.agg(F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"),
                    F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"))


def daily_history(df: DataFrame, ts: str, value: str, days: int = 30, tiebreak: str | None = None) -> DataFrame:
    """One entry per day (the day's first record wins), last ``days`` days.
    First-per-day is a ``min_by`` aggregation (partial, skew-safe); of records at one instant the
    one with the smallest ``tiebreak`` (else the smallest value) counts. The final
    limit is the report's own feature."""
    first = F.struct(F.col(ts), F.col(tiebreak if tiebreak else value))
    per_day = (df.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day"))
               .agg(F.min_by(F.col(value), first).alias("value"), F.min(ts).alias("first_ts")))
    return per_day.orderBy(F.col("day").desc()).limit(days)


def weighted_score(terms: Sequence[tuple[Column, float, float]]) -> Column:
    """Sum of ``least(x * weight, cap)`` terms (null terms count 0)."""
    out = F.lit(0.0)
    for x, w, cap in terms:
        out = out + F.coalesce(F.least(x * F.lit(w), F.lit(cap)), F.lit(0.0))
    return out


def issue_labels(checks: Sequence[tuple[Column, str]]) -> Column:
    """Labels of the checks that fail, as an array (no nulls)."""
    return F.filter(F.array(*[F.when(cond, F.lit(label)) for cond, label in checks]), lambda x: x.isNotNull())


def gap_report(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, kind: str) -> DataFrame:
    """Keys of ``left`` with no counterpart in ``right`` (anti join on derived keys)."""
    from .joins import join_small
    lk = left.select(left_key.alias("key")).where(F.col("key").isNotNull()).distinct()
    rk = right.select(right_key.alias("__rk")).where(F.col("__rk").isNotNull()).distinct()
    return join_small(lk, rk, F.col("key") == F.col("__rk"), "left_anti", materialize=True) \
        .select(F.lit(kind).alias("kind"), "key")


def issue_list(gaps: DataFrame, gate: DataFrame) -> DataFrame:
    """Gap rows and failed checks as one issue list with type, priority
    and recommendation."""
    g = gaps.select(F.lit("gap").alias("issue_type"), F.concat_ws(":", "kind", F.col("key").cast("string"))
                    .alias("subject"), F.lit("medium").alias("priority"),
                    F.concat(F.lit("add coverage for "), F.col("kind")).alias("recommendation"))
    c = gate.where(~F.col("passed")).select(F.lit("check").alias("issue_type"), F.col("check").alias("subject"),
                                            F.lit("high").alias("priority"),
                                            F.concat(F.lit("raise "), F.col("check"), F.lit(" above "),
                                                     F.col("minimum").cast("string")).alias("recommendation"))
    return g.unionByName(c)
