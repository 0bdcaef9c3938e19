"""Rule-based validation (V1-V18) as Column expressions.

``validate(df, rules)`` adds one ``violations`` column,
``array<struct<field, rule_id, rule_type, severity, message>>``, computed in
the same projection as the data: no per-row Python, no extra pass. Rows are
then split into valid and quarantine frames by severity (``split_valid``) or
handled by an error policy (``apply_error_policy``).

Rule dict keys: ``field``, ``type``, ``params`` (dict), optional ``id``,
``severity`` (critical/error/warning/info/debug/trace), ``message``
(template with ``{field}``, ``{value}``, ``{operator}``, ``{compare_to}``),
``enabled``, ``group``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_not_future
from ..functions.strings import length_ok

# Severity order and named format patterns.
SEVERITIES = ["trace", "debug", "info", "warning", "error", "critical"]
FORMAT_PATTERNS = {
    "email": r"^[\w\.-]+@[\w\.-]+\.\w+$",
    "phone": r"^[0-9]{10}$",
    "zip": r"^[0-9]{5}(-[0-9]{4})?$",
    "url": r"^https?://[^\s/$.?#].[^\s]*$",
}
TYPE_CHECKS = {"integer", "float", "number", "decimal", "boolean", "date", "string", "array", "object"}

VIOLATION_TYPE = ("struct<field:string,rule_id:string,rule_type:string,"
                  "severity:string,message:string>")

CustomFn = Callable[..., Column]
_CUSTOM: dict[str, CustomFn] = {}


def register_validator(name: str, fn: CustomFn) -> None:
    """``fn(column, **params) -> boolean Column`` (true = valid)."""
    _CUSTOM[name] = fn


@dataclass
class Rule:
    field: str
    type: str
    params: dict = field(default_factory=dict)
    id: str | None = None
    severity: str = "error"
    message: str | None = None
    enabled: bool = True
    group: str | None = None

    @classmethod
    def of(cls, r) -> Rule:
        if isinstance(r, Rule):
            return r
        r = dict(r)
        params = dict(r.pop("params", {}) or {})
        known = {"field", "type", "id", "severity", "message", "enabled", "group"}
        # bounds may sit at the rule's top level or under params; params win
        for k in list(r):
            if k not in known:
                params.setdefault(k, r.pop(k))
        return cls(params=params, **r)

    @property
    def rule_id(self) -> str:
        return self.id or f"{self.field}:{self.type}"


def _is_blank(c: Column) -> Column:
    return c.isNull() | c.cast("string").rlike(r"^\s*$")


def rule_ok(df_types: dict, r: Rule) -> Column:
    """Boolean Column: true where the row passes rule ``r``. Nulls pass every
    rule except ``required``."""
    c = F.col(r.field)
    p = r.params
    t = r.type
    if t == "required":
        return ~_is_blank(c)
    if t == "type":
        return _type_ok(c, df_types.get(r.field, "string"), p.get("data_type", p.get("type", "string")))
    if t == "pattern":
        pat = p["pattern"]
        if p.get("mode", "search") == "match":
            pat = f"^(?:{pat})"
        return c.isNull() | c.cast("string").rlike(pat)
    if t == "format":
        return c.isNull() | c.cast("string").rlike(FORMAT_PATTERNS[p["format"]])
    if t == "range":
        v = c.cast("string").try_cast("double") if df_types.get(r.field) == "string" else c.cast("double")
        ok = v.isNotNull()
        if p.get("min") is not None:
            ok = ok & (v >= float(p["min"]))
        if p.get("max") is not None:
            ok = ok & (v <= float(p["max"]))
        return c.isNull() | ok
    if t == "date_range":
        day = c.cast("string").try_cast("date") if df_types.get(r.field) == "string" else c.cast("date")
        ok = day.isNotNull()
        if p.get("min") is not None:
            ok = ok & (day >= F.lit(str(p["min"])).cast("date"))
        if p.get("max") is not None:
            ok = ok & (day <= F.lit(str(p["max"])).cast("date"))
        return c.isNull() | ok
    if t == "converted":
        # a value that the cleaning could not convert; ``raw`` holds the text before it
        raw = F.col(p["raw"]).cast("string")
        return _is_blank(raw) | c.isNotNull()
    if t == "length":
        return length_ok(c.cast("string"), p.get("min"), p.get("max"))
    if t == "enum":
        values = list(p["values"])
        if p.get("case_sensitive", True):
            return c.isNull() | c.cast("string").isin(values)
        return c.isNull() | F.lower(c.cast("string")).isin([str(v).lower() for v in values])
    if t == "custom":
        return c.isNull() | _CUSTOM[p["function"]](c, **p.get("args", {}))
    if t in ("compare", "date_compare"):
        other = F.col(p["compare_to"])
        a, b = (c.cast("date"), other.cast("date")) if t == "date_compare" else (c, other)
        return c.isNull() | other.isNull() | _compare(a, b, p.get("operator", "<="))
    if t == "precision":
        s = F.regexp_replace(F.col(p["raw"]).cast("string"), r"[$,%\s]", "") if p.get("raw") else F.trim(c.cast("string"))
        places = F.when(s.contains("."), F.length(F.substring_index(s, ".", -1))).otherwise(0)
        return c.isNull() | (places <= int(p["max_places"]))
    if t == "not_future":
        return date_not_future(c, p["as_of"])
    if t == "conditional":
        inner = Rule.of({"field": r.field, **p["rule"]})
        # an unknown condition is not a met one
        return ~F.coalesce(F.expr(p["when"]), F.lit(False)) | rule_ok(df_types, inner)
    if t == "derived":
        return c.isNull() | c.eqNullSafe(F.expr(p["expected"]))
    raise ValueError(f"unknown rule type {t!r}")


def _compare(a: Column, b: Column, op: str) -> Column:
    return {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b, "==": a == b, "!=": a != b,
            "less_than": a < b, "greater_than": a > b}[op]


def _type_ok(c: Column, actual: str, wanted: str) -> Column:
    wanted = {"number": "float", "decimal": "float", "text": "string"}.get(wanted, wanted)
    if actual != "string":
        static = {
            "integer": actual in ("int", "bigint", "smallint", "tinyint"),
            "float": actual in ("int", "bigint", "smallint", "tinyint", "double", "float") or
            actual.startswith("decimal"),
            "boolean": actual == "boolean",
            "date": actual in ("date", "timestamp", "timestamp_ntz"),
            "string": True,
            "array": actual.startswith("array"),
            "object": actual.startswith("struct") or actual.startswith("map"),
        }.get(wanted, True)
        return F.lit(static) | c.isNull()
    s = F.trim(c)
    check = {
        "integer": s.rlike(r"^[+-]?\d+$"),
        "float": s.try_cast("double").isNotNull(),
        "boolean": F.lower(s).isin("true", "false", "1", "0", "yes", "no", "y", "n", "t", "f"),
        "date": s.rlike(r"^\d{4}-\d{2}-\d{2}$"),
        "string": F.lit(True),
        "array": s.startswith("["),
        "object": s.startswith("{"),
    }.get(wanted, F.lit(True))  # unknown types pass
    return c.isNull() | check


def _message(r: Rule) -> Column:
    tmpl = r.message or f"{r.type} check failed for {{field}}"
    parts: list[Column] = []
    i = 0
    for m in re.finditer(r"\{(field|value|operator|compare_to)\}", tmpl):
        if m.start() > i:
            parts.append(F.lit(tmpl[i:m.start()]))
        key = m.group(1)
        if key == "field":
            parts.append(F.lit(r.field))
        elif key == "value":
            shown = r.params.get("raw") or r.field
            parts.append(F.coalesce(F.col(f"`{shown}`").cast("string"), F.lit("null")))
        elif key == "operator":
            parts.append(F.lit(str(r.params.get("operator", ""))))
        else:
            parts.append(F.lit(str(r.params.get("compare_to", ""))))
        i = m.end()
    if i < len(tmpl):
        parts.append(F.lit(tmpl[i:]))
    return F.concat(*parts) if parts else F.lit("")


def _violation(r: Rule, ok: Column) -> Column:
    v = F.struct(F.lit(r.field).alias("field"), F.lit(r.rule_id).alias("rule_id"),
                 F.lit(r.type).alias("rule_type"), F.lit(r.severity).alias("severity"),
                 _message(r).alias("message"))
    return F.when(~ok, v)


def _group_order(groups: dict[str, dict]) -> list[str]:
    """Topological order of validation groups by ``dependencies``; cycles rejected."""
    order: list[str] = []
    state: dict[str, int] = {}

    def visit(g, path=()):
        if state.get(g) == 2:
            return
        if state.get(g) == 1:
            raise ValueError(f"validation group cycle: {' -> '.join(path + (g,))}")
        state[g] = 1
        for d in groups.get(g, {}).get("dependencies", []) or []:
            visit(d, path + (g,))
        state[g] = 2
        order.append(g)

    for g in groups:
        visit(g)
    return order


def validate(df: DataFrame, rules: Sequence, *, groups: dict[str, dict] | None = None,
             first_only: bool = False, column: str = "violations") -> DataFrame:
    """Add the violations column for ``rules`` (disabled rules skipped).

    ``groups``: ``{name: {"dependencies": [...], "enabled": bool, "error_level": severity}}``; rules
    of a group are evaluated only on rows where every group it depends on passed, and an
    ``error_level`` is the severity of the group's rules of level ``error``.
    """
    types = dict(df.dtypes)
    rs = [Rule.of(r) for r in rules]
    groups = groups or {}
    rs = [r for r in rs if r.enabled and groups.get(r.group, {}).get("enabled", True)]
    for r in rs:
        level = groups.get(r.group, {}).get("error_level")
        if level and r.severity == "error":
            r.severity = level
    missing = sorted({r.field for r in rs if r.field not in types})
    if missing:
        raise ValueError(f"rules name fields not in the table: {missing}")
    group_ok: dict[str, Column] = {}
    gate: dict[str | None, Column] = {None: F.lit(True)}
    for g in _group_order({**{r.group: {} for r in rs if r.group}, **groups}):
        deps = groups.get(g, {}).get("dependencies", []) or []
        gate[g] = F.lit(True)
        for d in deps:
            gate[g] = gate[g] & gate.get(d, F.lit(True)) & group_ok.get(d, F.lit(True))
        oks = [rule_ok(types, r) for r in rs if r.group == g]
        ok_all = F.lit(True)
        for o in oks:
            ok_all = ok_all & F.coalesce(o, F.lit(False))
        group_ok[g] = ok_all
    items = []
    for r in rs:
        ok = F.coalesce(rule_ok(types, r), F.lit(False))
        g = gate.get(r.group, F.lit(True))
        items.append(_violation(r, ok | ~g))
    if not items:
        arr = F.array().cast(f"array<{VIOLATION_TYPE}>")
    else:
        arr = F.filter(F.array(*items), lambda x: x.isNotNull())
    if first_only:
        arr = F.slice(arr, 1, 1)
    return df.withColumn(column, arr)


def severity_at_least(threshold: str) -> list[str]:
    return SEVERITIES[SEVERITIES.index(threshold):]


def is_valid(column: str = "violations", threshold: str = "error", fields: Sequence[str] | None = None) -> Column:
    """No violation at or above ``threshold`` (of ``fields`` only, when given)."""
    levels = severity_at_least(threshold)

    def counts(v):
        return v["severity"].isin(levels) if fields is None else v["severity"].isin(levels) & v["field"].isin(list(fields))

    return ~F.exists(F.col(column), counts)


def split_valid(df: DataFrame, threshold: str = "error", column: str = "violations"):
    """(valid, quarantine) frames."""
    ok = is_valid(column, threshold)
    return df.where(ok), df.where(~ok)


def apply_error_policy(df: DataFrame, policy: str, threshold: str = "error",
                       column: str = "violations", max_errors: int | None = None,
                       fields: Sequence[str] | None = None) -> DataFrame:
    """``abort`` raises if any row fails (or more than ``max_errors``);
    ``skip`` keeps valid rows; ``log`` keeps every row with its violations.
    ``fields``: only their violations count (an entity's own source fields)."""
    if policy == "abort":
        bad = df.where(~is_valid(column, threshold, fields)).agg(F.count(F.lit(1))).first()[0]
        if bad > (max_errors or 0):
            raise ValueError(f"validation failed: {bad} invalid row(s) with error policy 'abort'")
        return df
    if policy == "skip":
        return df.where(is_valid(column, threshold, fields))
    if policy == "log":
        return df
    raise ValueError(f"unknown error policy {policy!r}")


def violation_ids(column: str = "violations") -> Column:
    """Comma-joined rule ids (flat text, handy for reports and checks)."""
    return F.array_join(F.transform(F.col(column), lambda v: v["rule_id"]), ",")


def validation_stats(df: DataFrame, column: str = "violations", threshold: str = "error") -> DataFrame:
    """One-row totals (partial aggregation): records, valid, invalid,
    violations, and violations per severity."""
    levels = severity_at_least(threshold)
    def of_severity(level):
        return lambda v: v["severity"] == level

    sev = {s: F.sum(F.size(F.filter(F.col(column), of_severity(s)))).cast("bigint").alias(f"n_{s}")
           for s in SEVERITIES}
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(~F.exists(F.col(column), lambda v: v["severity"].isin(levels))).alias("valid_records"),
        F.count_if(F.exists(F.col(column), lambda v: v["severity"].isin(levels))).alias("invalid_records"),
        F.sum(F.size(column)).cast("bigint").alias("violations"),
        *sev.values(),
    )


def violations_by_rule(df: DataFrame, column: str = "violations") -> DataFrame:
    """Violation counts per (field, rule_id, severity) — explode is per row,
    the count is a partial aggregation."""
    v = df.select(F.explode(column).alias("v")).select("v.*")
    return v.groupBy("field", "rule_id", "rule_type", "severity").agg(F.count(F.lit(1)).alias("n"))
