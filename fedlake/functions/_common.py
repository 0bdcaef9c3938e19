"""Small shared helpers for Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def on_bad(value: Column, ok: Column, on_error: str, message: str, original: Column | None = None) -> Column:
    """Apply an error policy to ``value`` where ``ok`` is false.

    ``null``  -> null (adapter behaviour)
    ``keep``  -> the original value, as text if the result has another type
    ``flag``  -> ``struct<value, error>``: the value where it is good, else null and ``message``
    ``raise`` -> fail the task with ``message`` (transformer behaviour)
    """
    if on_error == "keep":
        return value if original is None else F.when(ok, value.cast("string")).otherwise(original.cast("string"))
    if on_error == "flag":
        return F.struct(F.when(ok, value).alias("value"), F.when(~ok, F.lit(message)).alias("error"))
    if on_error == "raise":
        return F.when(ok, value).otherwise(F.raise_error(F.lit(message)))
    if on_error == "null":
        return F.when(ok, value)
    raise ValueError(f"on_error must be null, keep, flag or raise, got {on_error!r}")
