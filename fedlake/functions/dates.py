"""Date Column builders.

Formats are given in strptime notation (as the field rules declare them) and
translated once on the driver into Java datetime patterns.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._common import as_col

# strptime directive -> Java pattern letter(s); numeric ones have a variable
# width form (used next to separators) and a fixed width form (used when two
# numeric fields touch, e.g. %Y%m%d).
_DIRECTIVES = {
    "Y": ("yyyy", "yyyy"), "y": ("yy", "yy"),
    "m": ("M", "MM"), "d": ("d", "dd"),
    "H": ("H", "HH"), "I": ("h", "hh"), "M": ("m", "mm"), "S": ("s", "ss"),
    "f": ("SSSSSS", "SSSSSS"), "j": ("D", "DDD"),
    "b": ("MMM", "MMM"), "B": ("MMMM", "MMMM"), "a": ("EEE", "EEE"), "A": ("EEEE", "EEEE"),
    "p": ("a", "a"),
}


def strptime_to_java(fmt: str, for_output: bool = False) -> str:
    """Translate a strptime format into a Java DateTimeFormatter pattern.

    Parsing uses variable-width fields where a separator follows (strptime
    takes ``1/3/2024``); output always uses strftime's fixed widths.
    """
    tokens: list[tuple[str, str]] = []  # (kind, value): kind in {"d", "lit"}
    i = 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "%" and i + 1 < len(fmt):
            code = fmt[i + 1]
            if code == "%":
                tokens.append(("lit", "%"))
            elif code in _DIRECTIVES:
                tokens.append(("d", code))
            else:
                raise ValueError(f"unsupported strptime directive %{code}")
            i += 2
        else:
            tokens.append(("lit", ch))
            i += 1
    out = []
    for k, (kind, val) in enumerate(tokens):
        if kind == "lit":
            out.append(val if not val.isalpha() and val != "'" else ("''" if val == "'" else f"'{val}'"))
            continue
        touches = for_output or (k > 0 and tokens[k - 1][0] == "d") or (
            k + 1 < len(tokens) and tokens[k + 1][0] == "d")
        out.append(_DIRECTIVES[val][1 if touches else 0])
    return "".join(out)


def date_strip_time(c) -> Column:
    """drop a trailing time part (``2029-09-30 00:00:00`` -> ``2029-09-30``).

    Works on the text so it can run before the format parse.
    """
    return F.regexp_replace(as_col(c).cast("string"), r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$", "")


def date_parse_multi(c, formats=("%Y-%m-%d",), strip_time: bool = True) -> Column:
    """first format that parses wins; none -> null. Returns a date."""
    text = date_strip_time(c) if strip_time else as_col(c).cast("string")
    text = F.trim(text)
    tries = [F.try_to_timestamp(text, F.lit(strptime_to_java(f))) for f in formats]
    return F.coalesce(*tries).cast("date") if len(tries) > 1 else tries[0].cast("date")


def date_shift_format(c, days: int = 0, in_formats=("%Y-%m-%d",), out_format: str = "%Y-%m-%d") -> Column:
    """F32: parse, add ``days``, format."""
    d = date_parse_multi(c, in_formats)
    return F.date_format(F.date_add(d, days), strptime_to_java(out_format, for_output=True))


def date_not_future(c, as_of) -> Column:
    """date is not after ``as_of`` (a parameter, for determinism); null passes."""
    if isinstance(as_of, (_dt.date, str)):
        as_of = F.lit(str(as_of)).cast("date")
    c = as_col(c)
    return c.isNull() | (c.cast("date") <= as_of)


def fiscal_year(c, start_month: int = 10) -> Column:
    """fiscal year named for the calendar year in which it ends."""
    return F.year(F.add_months(as_col(c).cast("date"), (13 - start_month) % 12))


def fmt_date(c) -> Column:
    """ISO ``yyyy-MM-dd`` text."""
    return F.date_format(as_col(c), "yyyy-MM-dd")
