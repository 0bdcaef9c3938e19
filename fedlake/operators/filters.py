"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions._common import as_col


def filter_contains_ci(c, needle: str) -> Column:
    """Literal (not regex), case-insensitive substring test; null -> false."""
    return F.coalesce(F.upper(as_col(c)).contains(needle.upper()), F.lit(False))
