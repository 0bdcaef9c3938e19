"""Derived fields: row-wise aggregates, formulas, rule lists, calculation registry.

(A5, A6, F48, F50, F51, X1.) All of it compiles to Column expressions; the
only Python that can run per batch is an explicitly registered pandas
calculation (``register_pandas_calculation``), executed as an Arrow-batched
pandas UDF.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._common import as_col
from ..functions.ops import compile_ops

DEC = "decimal(38,6)"


def _cols(cols: Sequence) -> list[Column]:
    return [as_col(c) for c in cols]


def derive_sum(cols: Sequence, decimal: bool = True) -> Column:
    """A5: sum across columns skipping nulls; all null -> null."""
    cs = [c.cast(DEC) if decimal else c for c in _cols(cols)]
    total = sum((F.coalesce(c, F.lit(0).cast(DEC if decimal else "double")) for c in cs[1:]),
                F.coalesce(cs[0], F.lit(0).cast(DEC if decimal else "double")))
    return F.when(derive_count(cols) > 0, total)


def derive_count(cols: Sequence) -> Column:
    """A5: number of non-null values across columns."""
    return sum((F.when(c.isNotNull(), 1).otherwise(0) for c in _cols(cols)), F.lit(0))


def derive_avg(cols: Sequence, decimal: bool = True) -> Column:
    """A5: mean of the non-null values; all null -> null."""
    n = derive_count(cols)
    return F.when(n > 0, derive_sum(cols, decimal) / n)


def derive_min(cols: Sequence) -> Column:
    """A5: smallest non-null value (``least`` skips nulls)."""
    return F.least(*_cols(cols)) if len(cols) > 1 else _cols(cols)[0]


def derive_max(cols: Sequence) -> Column:
    """A5: largest non-null value."""
    return F.greatest(*_cols(cols)) if len(cols) > 1 else _cols(cols)[0]


def derive_concat(cols: Sequence, sep: str = "") -> Column:
    """Join non-null values with a separator."""
    return F.concat_ws(sep, *[c.cast("string") for c in _cols(cols)])


def derive_first_non_null(cols: Sequence) -> Column:
    """First non-null value in order (coalesce)."""
    return F.coalesce(*_cols(cols))


_FORMULA_OK = re.compile(r"^(?:\s|val\d+|\d+(?:\.\d+)?|[-+*/%(),]|abs|round|least|greatest|coalesce)*$")


def derive_formula(cols: Sequence[str], formula: str) -> Column:
    """arithmetic formula over ``val0..valN`` (the listed source columns).

    Only arithmetic, numbers and a few functions are accepted; the formula is
    compiled by Spark's SQL parser into a codegen'd expression (no eval).
    """
    if not _FORMULA_OK.match(formula):
        raise ValueError(f"formula has disallowed tokens: {formula!r}")

    def sub(m):
        i = int(m.group(1))
        if i >= len(cols):
            raise ValueError(f"formula refers to val{i} but only {len(cols)} sources given")
        return f"`{cols[i]}`"

    return F.expr(re.sub(r"val(\d+)", sub, formula))


# --- X1: calculation registry -------------------------------------------------------

CalcFn = Callable[..., Column]
_CALCULATIONS: dict[str, CalcFn] = {
    "sum": lambda cols, **p: derive_sum(cols, p.get("decimal", True)),
    "avg": lambda cols, **p: derive_avg(cols, p.get("decimal", True)),
    "count": lambda cols, **p: derive_count(cols),
    "min": lambda cols, **p: derive_min(cols),
    "max": lambda cols, **p: derive_max(cols),
    "concat": lambda cols, **p: derive_concat(cols, p.get("separator", "")),
    "first_non_null": lambda cols, **p: derive_first_non_null(cols),
    "coalesce": lambda cols, **p: derive_first_non_null(cols),
    "formula": lambda cols, **p: derive_formula(cols, p["formula"]),
}


def register_calculation(name: str, fn: CalcFn) -> None:
    """Register ``fn(list_of_columns, **params) -> Column`` under ``name``."""
    _CALCULATIONS[name] = fn


def register_pandas_calculation(name: str, fn: Callable, return_type: str = "double") -> None:
    """X1 fallback: a plain function over pandas Series, run Arrow-batched.

    The UDF is built when first used (on the driver), not at registration,
    so modules that register calculations import cleanly on executors."""
    def build(cols, **p):
        return F.pandas_udf(fn, return_type)(*_cols(cols))
    _CALCULATIONS[name] = build


def calculate(name: str, cols: Sequence, **params) -> Column:
    if name == "custom":
        name = params.pop("function")
    if name not in _CALCULATIONS:
        raise KeyError(f"unknown calculation type {name!r}")
    # formulas substitute source names; every other calculation gets Columns
    return _CALCULATIONS[name](list(cols) if name == "formula" else _cols(cols), **params)


def derive_fields(df: DataFrame, derived: dict[str, dict], on_missing: str = "raise") -> DataFrame:
    """Apply ``{target: {type, sources, default?, ...params}}`` derivations in one projection.

    A missing result takes ``default`` when one is given. A ``required`` field without a result fails
    the job (P16); ``on_missing="flag"`` instead collects the names of such fields in ``missing_fields``.
    """
    new: dict[str, Column] = {}
    missing: list[Column] = []
    for target, spec in derived.items():
        spec = dict(spec)
        kind = spec.pop("type", None) or spec.pop("calculation")
        # both spellings of the two configuration shapes
        sources = spec.pop("sources", None) or spec.pop("source_fields")
        spec.update(spec.pop("parameters", None) or {})
        required = spec.pop("required", False)
        default = spec.pop("default", None)
        col = calculate(kind, sources, **spec)
        if default is not None:
            col = F.coalesce(col, F.lit(default))
        if required and on_missing == "raise":
            col = F.when(col.isNotNull(), col).otherwise(F.raise_error(F.lit(f"required field {target} has no value")))
        elif required:
            missing.append(F.when(col.isNull(), F.lit(target)))
        new[target] = col
    if on_missing == "flag":
        new["missing_fields"] = F.array_compact(F.array(*missing)) if missing else F.array().cast("array<string>")
    return df.withColumns(new)


# --- F48 / F50 --------------------------------------------------------------------

def transform_rules(df: DataFrame, rules: Sequence[dict]) -> DataFrame:
    """apply a rule list (``{field, ops}``) to a table in one projection."""
    types = dict(df.dtypes)
    missing = [r["field"] for r in rules if r["field"] not in types]
    if missing:
        raise ValueError(f"rules name fields not in the table: {missing}")
    return df.withColumns({r["field"]: compile_ops(F.col(r["field"]), r.get("ops", []),
                                                   source_type=types[r["field"]]) for r in rules})


_KEEP_TYPES = {"string": "string", "integer": "bigint", "float": "double", "boolean": "boolean"}


def transform_keep_on_error(c, target: str) -> Column:
    """best-effort cast to string/integer/float/boolean; a failed cast
    keeps the original value (as text)."""
    c = as_col(c)
    return F.coalesce(c.try_cast(_KEEP_TYPES[target]).cast("string"), c.cast("string"))
