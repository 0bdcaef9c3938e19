"""Summary analysis operators.

``latest_by_group`` is the flagship: for each group, every record at the
group's most recent date, with the number of records tied at that date,
sorted by value (largest first), value shown as ``$#,##0.00`` and the date as
``yyyy-MM-dd``.

Plan shape (chosen for hot groups; one group may hold a third of all rows):

1. ``(group, date) -> count`` with map-side partial aggregation, then
   ``group -> (max date, count at max date)`` — only partial aggregates cross
   the network, never the raw rows of a hot group.
2. The per-group table (one row per group) is written; Spark broadcasts it when
   its size in bytes fits, so the fact side is filtered in place with no
   shuffle. Past the bound the join is a shuffle join on the group key, where
   AQE's skew-join splitting spreads a hot group over several tasks.

Null semantics follow the source analysis: null group keys are dropped; a
group whose dates are all null keeps all its rows (null matches null);
null values sort last.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache
from importlib.resources import files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import fmt_date
from ..functions.numbers import fmt_currency
from ..session import in_slice, materialize
from .joins import join_small


def default_fields() -> list[str]:
    """The record fields a report shows after its key (``report_fields.yaml``; ``row_count`` is the tie count it adds)."""
    return list(_field_lists()["report"])


def narrow_fields() -> list[str]:
    """The columns of the table the reports are made from."""
    return list(_field_lists()["narrow"])


@lru_cache
def _field_lists() -> dict[str, list[str]]:
    import yaml

    return yaml.safe_load(files("fedlake.plans").joinpath("report_fields.yaml").read_text(encoding="utf-8"))


def group_max(df: DataFrame, group: str, date: str, alias: str = "max_date") -> DataFrame:
    """A1: max date per group; null group keys dropped (partial aggregation)."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.max(date).alias(alias))


def group_size(df: DataFrame, group: str, alias: str = "row_count") -> DataFrame:
    """A2: rows per group (null keys dropped as pandas groupby does)."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias(alias))


def latest_date_table(df: DataFrame, group: str, date: str, with_total: bool = False) -> DataFrame:
    """Per group: latest date (``_max_date``) and the number of rows at it
    (``row_count``), optionally all rows (``total_count``).

    Two partial aggregations; a group with only null dates gets a null
    ``_max_date`` and the count of its null-date rows.
    """
    per_day = (df.where(F.col(group).isNotNull())
               .groupBy(group, date).agg(F.count(F.lit(1)).alias("_n")))
    aggs = [
        F.max(date).alias("_max_date"),
        F.max_by("_n", date).alias("_n_at_max"),
        F.sum(F.when(F.col(date).isNull(), F.col("_n"))).alias("_n_null"),
    ]
    if with_total:
        aggs.append(F.sum("_n").alias("total_count"))
    out = per_day.groupBy(group).agg(*aggs)
    cols = [F.col(group).alias("_g"), "_max_date",
            F.coalesce("_n_at_max", "_n_null").alias("row_count")]
    if with_total:
        cols.append("total_count")
    return out.select(*cols)


def latest_records(df: DataFrame, group: str, date: str, with_total: bool = False, slices: int = 1) -> DataFrame:
    """All rows at their group's latest date plus ``row_count`` (and
    ``total_count``); unformatted, unsorted.

    ``slices``, for a large ``df``: where the group table is not broadcast the rows are joined in so many slices of the key,
    and what is latest is written, so that the exchanges on disk are those of one slice and of the few rows that stay."""
    table = latest_date_table(df, group, date, with_total)
    keyed = df.where(F.col(group).isNotNull())
    cond = (F.col(group) == F.col("_g")) & F.col(date).eqNullSafe(F.col("_max_date"))
    joined = join_small(keyed, table, cond, "inner", materialize=True).drop("_g", "_max_date")
    if slices > 1 and "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString():
        joined, _ = materialize([joined.where(in_slice([F.col(group)], k, slices)) for k in range(slices)], "latest-records",
                                compression="zstd")
    return joined


def _report_fields(df: DataFrame, group: str, fields, additional_fields, with_total: bool) -> list[str]:
    """Report columns, each once: the group key, the report's fields, then the extra ones that the table has.

    Of the default fields those that the table lacks are left out, with a warning; fields asked for must be there."""
    extras = set(additional_fields or ()) & set(df.columns)
    if fields is None:
        there = {*df.columns, "row_count"}
        if absent := [f for f in default_fields() if f not in there]:
            warnings.warn(f"report columns not in the input: {', '.join(absent)}", stacklevel=3)
        fields = [f for f in default_fields() if f in there]
    shown = [group, *fields,
             *filter(extras.__contains__, additional_fields or ()), *["total_count"] * with_total]
    return list(dict.fromkeys(shown))


def _report(rows: DataFrame, group: str, date: str, value: str, out_fields: list[str], formatted: bool,
            tiebreak: Sequence[str]) -> DataFrame:
    """Sort by value (largest first, nulls last), then format value and date.

    The remaining output fields extend the sort key, so rows sharing one hot
    value still spread over several range partitions."""
    keys = [value, group, *tiebreak]
    rest = [f for f in out_fields if f not in keys and f in rows.columns]
    ordered = rows.orderBy(F.col(value).desc_nulls_last(), F.col(group).asc_nulls_last(),
                           *[F.col(t).asc_nulls_last() for t in [*tiebreak, *rest]])
    sel: list[Column] = []
    for f in out_fields:
        if formatted and f == value:
            sel.append(fmt_currency(F.col(f)).alias(f))
        elif formatted and f == date:
            sel.append(fmt_date(F.col(f)).alias(f))
        else:
            sel.append(F.col(f))
    return ordered.select(*sel)


def latest_by_group(df: DataFrame, group: str, date: str = "last_modified_date",
                    value: str = "potential_total_value_of_award",
                    fields: Sequence[str] | None = None,
                    additional_fields: Sequence[str] | None = None,
                    *, formatted: bool = True, with_total: bool = False,
                    tiebreak: Sequence[str] = (), slices: int = 1) -> DataFrame:
    """A3: latest record(s) per group with tie count, sorted by value desc.

    ``fields`` are the default output fields after the group key (award schema
    defaults); ``additional_fields`` are appended when present in ``df`` and
    not already listed. ``with_total`` adds ``total_count`` (all rows of the
    group), the modification count the source describes but does not compute.
    ``tiebreak`` columns extend the sort so that a limit on top is deterministic.
    ``slices`` as in ``latest_records``.
    """
    out_fields = _report_fields(df, group, fields, additional_fields, with_total)
    needed = [c for c in dict.fromkeys(out_fields + [date, value, group] + list(tiebreak))
              if c not in ("row_count", "total_count")]
    rows = latest_records(df.select(*needed), group, date, with_total, slices)
    return _report(rows, group, date, value, out_fields, formatted, tiebreak)


def latest_by_group_many(df: DataFrame, views: Sequence[tuple[str, Sequence[str]]],
                         date: str = "last_modified_date", value: str = "potential_total_value_of_award",
                         fields: Sequence[str] | None = None, *, formatted: bool = True,
                         concurrent_jobs: int = 4, slices: int = 1) -> list[DataFrame]:
    """A4: several latest-per-group reports ``(group, additional fields)`` over one table.

    Each key has a pass of its own over two columns, the key in its own type and the date, aggregated before the shuffle:
    a key of few values ships a few rows per task, and no row is multiplied by the number of views. The passes are
    independent and small, so they are submitted together. ``df`` is read once per view: hand over a table.
    ``slices`` as in ``latest_records``.
    """
    def report(view: tuple[str, Sequence[str]]) -> DataFrame:
        return latest_by_group(df, view[0], date, value, fields, view[1], formatted=formatted, slices=slices)

    with ThreadPoolExecutor(max(1, concurrent_jobs)) as pool:
        return list(pool.map(report, views))


def latest_by_group_join_form(df: DataFrame, group: str, date: str) -> DataFrame:
    """J1 + J2 as joins (the source's literal formulation): rows joined to the
    per-group max on (group, date) null-safely, then per-group counts joined
    back. Same answer as ``latest_records``; kept as the reference form."""
    gmax = group_max(df, group, date, "_max_date").withColumnRenamed(group, "_g")
    keyed = df.where(F.col(group).isNotNull())
    cond = (F.col(group) == F.col("_g")) & F.col(date).eqNullSafe(F.col("_max_date"))
    tied = join_small(keyed, gmax, cond, "inner", materialize=True).drop("_g", "_max_date")
    counts = group_size(tied, group).withColumnRenamed(group, "_g2")
    return join_small(tied, counts, F.col(group) == F.col("_g2"), "inner", materialize=True).drop("_g2")


def sort_mixed(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """Multi-key sort, each key (name, ascending); nulls last."""
    return df.orderBy(*[F.col(k).asc_nulls_last() if asc else F.col(k).desc_nulls_last() for k, asc in keys])


def top_n(df: DataFrame, order: Sequence[tuple[str, bool]], n: int = 100) -> DataFrame:
    """First ``n`` rows of a total order (TakeOrderedAndProject)."""
    return sort_mixed(df, order).limit(n)


def with_position(df: DataFrame, keys: Sequence[tuple[str, bool]], name: str = "pos") -> DataFrame:
    """Global 1-based position under a total order, without a single-task window.

    Range-partitioned sort, written once with each row's partition id and
    in-partition sequence stored; per-partition row counts (one row per partition) give each
    partition its offset. The data itself never sits in one task. ``keys``
    must form a total order (add a unique tiebreak) for positions to be stable.
    """
    from pyspark.sql import Window

    sorted_df, _ = materialize(sort_mixed(df, keys)
                               .withColumn("_pid", F.spark_partition_id())
                               .withColumn("_mid", F.monotonically_increasing_id()), "sorted")
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_min_mid"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_min_mid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    joined = sorted_df.join(offsets, "_pid")  # one row per partition
    return (joined.withColumn(name, F.col("_off") + (F.col("_mid") - F.col("_min_mid")) + 1)
            .drop("_pid", "_mid", "_off", "_min_mid"))
