"""Join helpers: joins sized by statistics, null-safe keys, FK checks.

No side is hinted. Spark broadcasts a side only when its file sizes (times
``spark.sql.sources.fileCompressionFactor``) or the bytes AQE has seen at run
time fit under ``spark.sql.autoBroadcastJoinThreshold``; otherwise the join
stays a shuffle join, where AQE's skew-join handling splits a hot key's
partition across several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize as _materialize


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", *, materialize: bool = False) -> DataFrame:
    """Join ``big`` with a side that is often, but not surely, small.

    ``materialize`` writes a derived ``small`` to the shared folder first, so
    its real size in bytes is known to the planner and it is computed once.
    """
    if materialize:
        small, _ = _materialize(small, "join-side")
    return big.join(small, on, how)


def null_safe_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for lk, rk in pairs:
        c = left[lk].eqNullSafe(right[rk])
        cond = c if cond is None else cond & c
    return cond


def _key_set(parent: DataFrame, parent_key: str) -> DataFrame:
    return parent.select(F.col(parent_key).alias("__pk")).where(F.col("__pk").isNotNull()).distinct()


def fk_valid(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose key exists in ``parent`` (J7, semi join against
    the distinct parent keys)."""
    return join_small(child, _key_set(parent, parent_key), F.col(child_key) == F.col("__pk"), "left_semi",
                      materialize=True)


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of ``child`` with a non-null key that is missing in ``parent`` (J7, anti join)."""
    return join_small(child.where(F.col(child_key).isNotNull()), _key_set(parent, parent_key),
                      F.col(child_key) == F.col("__pk"), "left_anti", materialize=True)
