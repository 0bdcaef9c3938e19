"""Number and money Column builders.

ANSI mode is on in Spark 4, so every parse goes through ``try_cast``: bad
text becomes null (adapter semantics) instead of failing the task. Money is
``decimal(18,2)`` end to end; rounding happens on decimals, never on doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._common import as_col, on_bad
from .strings import str_strip_chars, str_trim

MONEY = "decimal(18,2)"
MONEY_TEXT = r"^-?\$?\s*\d+(?:,\d{3})*(?:\.\d{2})?$"


def num_parse(c, precision: int | None = None) -> Column:
    """trimmed text -> double; bad -> null; optional half-even rounding."""
    v = str_trim(as_col(c).cast("string")).try_cast("double")
    if precision is not None:
        v = F.bround(v.try_cast("decimal(38,10)"), precision).cast("double")
    return v


def num_int(c) -> Column:
    """integer via float, truncating toward zero (``int(float(x))``)."""
    return str_trim(as_col(c).cast("string")).try_cast("double").try_cast("bigint")


def num_decimal(c, scale: int = 2, precision: int = 18) -> Column:
    """text -> decimal(precision, scale); bad -> null."""
    return str_trim(as_col(c).cast("string")).try_cast(f"decimal({precision},{scale})")


def num_round_clamp(c, ndigits: int | None = None, min_value=None, max_value=None,
                    integer: bool = False, on_error: str = "null", numeric_input: bool = False) -> Column:
    """parse, round half-even on a decimal, clamp to [min, max], optional int.

    ``on_error='raise'`` fails on unparseable input as the transformer does.
    ``numeric_input`` skips the text parse for columns that are already numbers.
    """
    raw = as_col(c)
    v = raw.try_cast("decimal(38,10)") if numeric_input else str_trim(raw.cast("string")).try_cast("decimal(38,10)")
    if ndigits is not None:
        v = F.bround(v, ndigits)
    if min_value is not None:
        v = F.when(v.isNotNull() & (v < F.lit(min_value)), F.lit(min_value).cast("decimal(38,10)")).otherwise(v)
    if max_value is not None:
        v = F.when(v.isNotNull() & (v > F.lit(max_value)), F.lit(max_value).cast("decimal(38,10)")).otherwise(v)
    out = v.cast("bigint") if integer else v.cast("double")
    return on_bad(out, raw.isNull() | v.isNotNull(), on_error, "Invalid numeric value", raw)


def money_parse(c) -> Column:
    """strip ``$`` and ``,`` (never the decimal point), then decimal(18,2)."""
    return str_trim(str_strip_chars(as_col(c), "$,")).try_cast(MONEY)


def money_valid(c) -> Column:
    """money text shape and parseability; null passes."""
    c = as_col(c).cast("string")
    return c.isNull() | (c.rlike(MONEY_TEXT) & money_parse(c).isNotNull())


def percent_parse(c, scale: int = 3) -> Column:
    """strip ``%`` then decimal with 3 places (range is a separate rule)."""
    return str_trim(str_strip_chars(as_col(c), "%")).try_cast(f"decimal(10,{scale})")


def fmt_currency(c) -> Column:
    """``$#,##0.00``; the sign follows the dollar sign (``$-5.00``)."""
    c = as_col(c)
    return F.concat(F.lit("$"), F.format_number(c, 2))
