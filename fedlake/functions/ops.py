"""Compile declarative transform operations into Column expressions.

An operation is a dict such as ``{"type": "pad_left", "length": 3,
"character": "0"}``, the shape the field-property rules use. ``compile_ops``
folds a list of them over one column; the result is a single expression that
Spark evaluates inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codes, dates, numbers, strings
from ._common import as_col


def compile_op(c: Column, op: dict, *, source_type: str | None = None) -> Column:
    t = op["type"]
    if t == "trim":
        return strings.str_trim(c)
    if t in ("uppercase", "upper"):
        return F.upper(c)
    if t in ("lowercase", "lower"):
        return F.lower(c)
    if t == "title":
        return strings.str_title(c)
    if t == "strip_characters":
        return strings.str_strip_chars(c, op["characters"])
    if t == "pad_left":
        return strings.str_pad(c, int(op["length"]), op.get("character", " "), "left")
    if t == "pad_right":
        return strings.str_pad(c, int(op["length"]), op.get("character", " "), "right")
    if t == "truncate":
        return strings.str_truncate(c, int(op["max_length"]))
    if t == "extract_pattern":
        return strings.str_extract(c, op["pattern"])
    if t == "replace":
        return strings.str_regex_replace(c, op["pattern"], op.get("replacement", ""))
    if t == "format":
        return strings.str_format(c, op["template"])
    if t == "map_values":
        return strings.map_values(c, op["mapping"])
    if t == "normalize_zip":
        return strings.norm_zip(c, op.get("mode", "zip5_4"))
    if t == "convert_to_decimal":
        if source_type in ("double", "float", "bigint", "int", "smallint", "tinyint") or source_type and \
                source_type.startswith("decimal"):
            return c.try_cast(f"decimal(18,{int(op.get('scale', 2))})")
        return numbers.num_decimal(c, int(op.get("scale", 2)))
    if t == "convert_to_integer":
        if source_type in ("bigint", "int", "smallint", "tinyint"):
            return c.cast("bigint")
        return numbers.num_int(c)
    if t == "convert_to_float":
        return numbers.num_parse(c)
    if t == "round":
        numeric = bool(source_type) and (source_type in ("double", "float", "bigint", "int", "smallint", "tinyint")
                                         or source_type.startswith("decimal"))
        return numbers.num_round_clamp(c, int(op.get("ndigits", 0)), op.get("min_value"), op.get("max_value"),
                                       numeric_input=numeric)
    if t == "strip_time":
        return dates.date_strip_time(c)
    if t == "normalize_date":
        d = dates.date_parse_multi(c, tuple(op.get("input_formats", ("%Y-%m-%d",))))
        out = op.get("output_format")
        return F.date_format(d, dates.strptime_to_java(out, for_output=True)) if out else d
    if t == "normalize_boolean":
        return codes.bool_normalize(c, op.get("true_values", codes.NORMALIZE_TRUE),
                                    op.get("false_values", codes.NORMALIZE_FALSE))
    if t == "parse_boolean":
        return codes.bool_parse(c)
    if t == "decode":
        return codes.code_decode(c, op["table"])
    if t == "derive_fiscal_year":
        src = F.col(op["source_field"]) if op.get("source_field") else c
        return dates.fiscal_year(src, int(op.get("fiscal_year_start_month", 10)))
    raise ValueError(f"unsupported transform operation {t!r}")


def compile_ops(c, ops: Sequence[dict], *, source_type: str | None = None) -> Column:
    out = as_col(c)
    for i, op in enumerate(ops):
        out = compile_op(out, op, source_type=source_type if i == 0 else None)
    return out
