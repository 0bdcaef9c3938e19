"""String cleaning Column builders.

Every builder takes a Column (or column name) and returns a Column, so a
whole table is cleaned inside one codegen'd projection. Python-isms the
source semantics depend on (``str.strip`` on all whitespace, ``str.title``
capitalising after any non-letter, padding that never truncates) are spelled
out with built-in functions; nothing runs row-at-a-time in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._common import as_col, on_bad


def str_trim(c) -> Column:
    """strip leading/trailing whitespace of every kind (not only spaces)."""
    c = as_col(c).cast("string")
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def str_upper(c) -> Column:
    return F.upper(as_col(c))


def str_lower(c) -> Column:
    return F.lower(as_col(c))


def str_title(c) -> Column:
    """Python ``str.title``: each run of letters gets an upper first letter
    and lower rest, so letters after ``'`` or ``-`` are capitalised too."""
    parts = F.regexp_extract_all(as_col(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    fixed = F.transform(
        parts,
        lambda s: F.when(s.rlike(r"^\p{L}"),
                         F.concat(F.upper(s.substr(F.lit(1), F.lit(1))), F.lower(s.substr(F.lit(2), F.length(s)))))
        .otherwise(s),
    )
    return F.when(as_col(c).isNull(), F.lit(None).cast("string")).otherwise(F.array_join(fixed, ""))


def str_pad(c, length: int, char: str = " ", side: str = "left") -> Column:
    """pad to ``length`` but never truncate longer input (lpad/rpad would)."""
    c = as_col(c).cast("string")
    padded = F.lpad(c, length, char) if side == "left" else F.rpad(c, length, char)
    return F.when(F.length(c) < length, padded).otherwise(c)


def str_match(c, pattern: str, on_error: str = "null") -> Column:
    """value must match ``pattern`` at its start (prefix match)."""
    c = as_col(c)
    ok = c.rlike(f"^(?:{pattern})")
    return on_bad(c, c.isNull() | ok, on_error, f"Value does not match pattern: {pattern}", c)


def str_strip_chars(c, chars: str) -> Column:
    """delete every occurrence of each character in ``chars``."""
    return F.translate(as_col(c).cast("string"), chars, "")


def str_extract(c, pattern: str) -> Column:
    """first match of ``pattern`` anywhere, or null."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, 0), F.lit(""))


def str_truncate(c, n: int) -> Column:
    """F8: keep at most ``n`` characters."""
    return F.substring(as_col(c), 1, n)


def str_regex_replace(c, pattern: str, replacement: str) -> Column:
    """F9."""
    return F.regexp_replace(as_col(c), pattern, replacement)


def str_format(c, template: str) -> Column:
    """``template`` with ``{value}`` (or ``{}``) replaced by the value."""
    fmt = template.replace("%", "%%").replace("{value}", "%s").replace("{}", "%s")
    c = as_col(c)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.format_string(fmt, c.cast("string")))


def map_values(c, mapping: dict) -> Column:
    """translate mapped values, pass unmapped ones through."""
    c = as_col(c)
    if not mapping:
        return c
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, c), c)


def norm_zip(c, mode: str = "zip5_4") -> Column:
    """ZIP normalisation.

    ``zip5_4`` (config rule): 9 digits -> ``#####-####``, up to 5 digits ->
    left-padded to 5, anything else -> null.
    ``zip5`` (standard transform): strip spaces/dashes, left-pad to 5, keep 5.
    """
    c = as_col(c).cast("string")
    if mode == "zip5":
        s = F.translate(c, " -", "")
        return F.substring(str_pad(s, 5, "0", "left"), 1, 5)
    d = F.regexp_replace(c, r"[^0-9]", "")
    n = F.length(d)
    return (F.when(n == 9, F.concat(F.substring(d, 1, 5), F.lit("-"), F.substring(d, 6, 4)))
            .when((n >= 1) & (n <= 5), F.lpad(d, 5, "0")))


# The standard normalisation chains for code columns, as the
# source configuration declares them.
COUNTRY_ALIASES = {"US": "USA", "U.S.": "USA", "U.S.A.": "USA", "United States": "USA"}


def norm_code(c, kind: str) -> Column:
    """standard chains for agency code, UEI, phone, NAICS, PSC, state, country."""
    c = as_col(c).cast("string")
    if kind == "agency_code":
        return str_pad(str_trim(c), 3, "0", "left")
    if kind in ("uei", "psc"):
        return F.upper(c)
    if kind == "naics":
        return str_strip_chars(c, "- .")
    if kind == "phone":
        return str_extract(str_strip_chars(c, "()- ."), "[0-9]{10}")
    if kind == "state":
        return str_trim(F.upper(c))
    if kind == "country":
        # map_values runs on the upper-cased, trimmed text, as the chain orders it
        return map_values(str_trim(F.upper(c)), COUNTRY_ALIASES)
    if kind == "truncate_4000":
        return str_truncate(c, 4000)
    raise ValueError(f"unknown code kind {kind!r}")


def length_ok(c, min_length: int | None = None, max_length: int | None = None) -> Column:
    """inclusive length bounds; null passes."""
    c = as_col(c)
    cond = F.lit(True)
    if min_length is not None:
        cond = cond & (F.length(c) >= min_length)
    if max_length is not None:
        cond = cond & (F.length(c) <= max_length)
    return c.isNull() | cond
