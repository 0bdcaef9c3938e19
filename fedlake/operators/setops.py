"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """Union all by column name; a column missing on one side is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def set_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` not in ``right`` (SQL EXCEPT)."""
    return left.subtract(right)


def set_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct union (SQL UNION)."""
    return left.union(right).distinct()
