"""Entity mapping (P4-P18) compiled from a YAML-shaped spec into Columns.

A spec looks like the conversion config's entity section::

    {"key_fields": [...],
     "field_mappings": {"direct": {target: source},
                        "multi_source": {target: {"sources": [...], "strategy": "first_non_empty"}},
                        "object": {name: {"type": "object", "fields": {...}, "nested_objects": {...}}},
                        "reference": {name: {"entity": e, "key_field": f} or
                                            {"entity": e, "key_prefix": p, "key_fields": [...]}},
                        "template": {name: {"type": "object", "fields": {sub: {"type": "template",
                                                                              "templates": {k: "{a}:{b}"}}}}}},
     "entity_processing": {"processing_order": n}}

The driver only walks the spec; every record is mapped by Spark in one
projection. A source column missing from the input becomes a typed null and
a warning (``MISSING_SOURCES``); a value in an object mapping that is not an
input column is a literal constant.
"""

from __future__ import annotations

import fnmatch
import re
import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING_SOURCES: set[str] = set()


def _src(df_cols: set[str], name: str, declared: dict[str, str] | None = None) -> Column:
    if name in df_cols:
        return F.col(f"`{name}`")
    if name not in MISSING_SOURCES:
        warnings.warn(f"mapping source column {name!r} is not in the input; using null", stacklevel=3)
        MISSING_SOURCES.add(name)
    return F.lit(None).cast((declared or {}).get(name, "string"))


def source_schema(spec: dict) -> dict[str, str]:
    """The source columns that a spec declares, name -> type: ``source_columns`` as a list of names (text) or a mapping."""
    declared = spec.get("source_columns") or {}
    return dict(declared) if isinstance(declared, dict) else dict.fromkeys(declared, "string")


def map_direct(df: DataFrame, mapping: dict[str, str], declared: dict[str, str] | None = None) -> dict[str, Column]:
    """copy/rename; a missing source column gives a null of its declared type (else text)."""
    cols = set(df.columns)
    return {t: _src(cols, s, declared) for t, s in mapping.items()}


def map_multi_source(df: DataFrame, sources: Sequence[str], strategy: str = "first_non_null") -> Column:
    """P5: first non-null source in order; ``first_non_empty`` also skips blanks."""
    cols = set(df.columns)
    types = dict(df.dtypes)
    cs = [_src(cols, s) for s in sources]
    if len({types[s] for s in sources if s in types}) > 1:
        # mixed source types: compare as text rather than let ANSI coercion
        # cast text to a number (which fails at run time)
        cs = [c.cast("string") for c in cs]
    if strategy == "first_non_empty":
        cs = [F.when(~c.cast("string").rlike(r"^\s*$"), c) for c in cs]
    return F.coalesce(*cs) if len(cs) > 1 else cs[0]


def map_object(df: DataFrame, spec: dict, declared: dict[str, str] | None = None) -> Column:
    """Nested struct from ``fields`` and ``nested_objects``.

    A field value naming an input column, or a column of the ``declared`` source schema (name -> type), reads it; any
    other value (``primary``, ``"true"``, ``not_applicable``) is a constant. A declared column that the input lacks, or
    one written ``{"field": name}``, reads as a null of its declared type (else text), with a warning."""
    cols = set(df.columns)
    parts = []
    for k, v in (spec.get("fields") or {}).items():
        if isinstance(v, dict):
            parts.append((_src(cols, v["field"], declared) if set(v) == {"field"} else map_object(df, v, declared)).alias(k))
        elif isinstance(v, str) and (v in cols or v in (declared or {})):
            parts.append(_src(cols, v, declared).alias(k))
        else:
            parts.append(F.lit(v).alias(k))
    for k, v in (spec.get("nested_objects") or {}).items():
        parts.append(map_object(df, v, declared).alias(k))
    return F.struct(*parts)


def map_reference(df: DataFrame, spec: dict) -> Column:
    """P10: reference to another entity: ``struct(entity, reference_type, key)``.

    The key is one field, or ``prefix_<field>`` values joined with ``:``
    (a missing part stays an empty position so keys remain aligned).
    """
    cols = set(df.columns)
    if "key_field" in spec:
        key = _src(cols, spec["key_field"]).cast("string")
    else:
        prefix = spec.get("key_prefix")
        names = [f"{prefix}_{k}" if prefix else k for k in spec["key_fields"]]
        parts = [_src(cols, n).cast("string") for n in names]
        # no part at all is no reference
        key = F.when(F.coalesce(*parts).isNotNull(), F.concat_ws(":", *[F.coalesce(p, F.lit("")) for p in parts]))
    return F.struct(F.lit(spec.get("entity")).alias("entity"),
                    F.lit(spec.get("reference_type")).cast("string").alias("reference_type"),
                    key.alias("key"))


_TEMPLATE_PART = re.compile(r"\{([^{}]+)\}")


def map_template(df: DataFrame, template: str) -> Column:
    """``"{a}:{b}"``; null when any referenced field is null (not the word null)."""
    cols = set(df.columns)
    parts: list[Column] = []
    i = 0
    for m in _TEMPLATE_PART.finditer(template):
        if m.start() > i:
            parts.append(F.lit(template[i:m.start()]))
        parts.append(_src(cols, m.group(1)).cast("string"))
        i = m.end()
    if i < len(template):
        parts.append(F.lit(template[i:]))
    return F.concat(*parts)


def map_template_object(df: DataFrame, spec: dict) -> Column:
    """An object whose fields are groups of templates (``agencies.awarding.ref``)."""
    return _template_object(df, spec)


def _template_object(df: DataFrame, spec: dict) -> Column:
    parts = []
    for k, v in (spec.get("fields") or {}).items():
        if v.get("type") == "template":
            parts.append(F.struct(*[map_template(df, t).alias(n) for n, t in v["templates"].items()]).alias(k))
        else:
            parts.append(_template_object(df, v).alias(k))
    return F.struct(*parts)


def compile_mappings(df: DataFrame, spec: dict) -> dict[str, Column]:
    """All mappings of one entity, in declaration order of the mapping kinds; its ``source_columns`` tell lost columns
    from constants."""
    fm, declared = normalise(spec).get("field_mappings", {}), source_schema(spec)
    out: dict[str, Column] = {}
    out.update(map_direct(df, fm.get("direct") or {}, declared))
    for t, ms in (fm.get("multi_source") or {}).items():
        out[t] = map_multi_source(df, ms["sources"], ms.get("strategy", "first_non_null"))
    for t, ob in (fm.get("object") or {}).items():
        out[t] = map_object(df, ob, declared)
    for t, rf in (fm.get("reference") or {}).items():
        out[t] = map_reference(df, rf)
    for t, tp in (fm.get("template") or {}).items():
        out[t] = _template_object(df, tp) if tp.get("type") == "object" else map_template(df, tp["template"])
    return out


def map_entity(df: DataFrame, spec: dict, keep: Sequence[str] = ()) -> DataFrame:
    """Mapped entity rows (one per input row), optional pass-through columns."""
    m = compile_mappings(df, spec)
    return df.select(*[F.col(k) for k in keep], *[c.alias(n) for n, c in m.items()])


def key_column(name: str) -> Column:
    """Key fields may be dotted paths into mapped structs (``address.line1``)."""
    return F.col(name)


_KINDS = {"direct", "multi_source", "object", "reference", "template"}


def normalise(spec: dict) -> dict:
    """The other two shapes of a mapping as the canonical one.

    ``field_mappings: {target: {"field": source}}`` and ``fields: [{"source", "target", "transforms"}]`` become
    ``field_mappings.direct``; the latter's transforms become ``transforms``, a rule list for ``transform_rules``."""
    fm = spec.get("field_mappings") or {}
    if isinstance(spec.get("fields"), list):
        rules = [{"field": f["source"], "ops": f["transforms"]} for f in spec["fields"] if f.get("transforms")]
        rest = {k: v for k, v in spec.items() if k != "fields"}
        return {**rest, "transforms": rules,
                "field_mappings": {"direct": {f["target"]: f["source"] for f in spec["fields"]}}}
    if fm and not set(fm) <= _KINDS:
        return {**spec, "field_mappings": {"direct": {t: m["field"] if isinstance(m, dict) else m for t, m in fm.items()}}}
    return spec


def mapped_sources(spec: dict) -> list[str]:
    fm = normalise(spec).get("field_mappings", {})
    srcs: list[str] = list((fm.get("direct") or {}).values())
    for ms in (fm.get("multi_source") or {}).values():
        srcs += ms["sources"]

    def walk(ob):
        for v in (ob.get("fields") or {}).values():
            if isinstance(v, dict) and set(v) == {"field"}:
                srcs.append(v["field"])
            elif isinstance(v, dict):
                walk(v)
            elif isinstance(v, str):
                srcs.append(v)
        for v in (ob.get("nested_objects") or {}).values():
            walk(v)
    for ob in (fm.get("object") or {}).values():
        walk(ob)
    return list(dict.fromkeys(srcs))


def spec_sources(spec: dict) -> list[str]:
    """Every input column a spec reads (mappings, reference keys, templates), in
    a fixed order: direct, multi-source, object fields, references, templates."""
    spec = normalise(spec)
    srcs = mapped_sources(spec)
    for rf in (spec.get("field_mappings", {}).get("reference") or {}).values():
        if "key_field" in rf:
            srcs.append(rf["key_field"])
        else:
            p = rf.get("key_prefix")
            srcs += [f"{p}_{k}" if p else k for k in rf["key_fields"]]
    for tp in (spec.get("field_mappings", {}).get("template") or {}).values():
        srcs += _TEMPLATE_PART.findall(str(tp))
    return list(dict.fromkeys(srcs))


def key_values(df: DataFrame, spec: dict) -> list[Column]:
    """The values of an entity's key fields, after mapping; no warning of absent sources."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        m = compile_mappings(df, spec)
    cols, out = set(df.columns), []
    for k in spec.get("key_fields", []):
        head, _, rest = k.partition(".")
        kc = m[head] if head in m else _src(cols, head)
        if rest:
            for part in rest.split("."):
                kc = kc.getField(part)
        out.append(kc)
    return out


def entity_match(df: DataFrame, spec: dict) -> Column:
    """All key fields present (after mapping) and any mapped source present.
    Raw records are heterogeneous, so absent sources are expected here (no warning)."""
    cols = set(df.columns)
    cond = F.lit(True)
    for kc in key_values(df, spec):
        cond = cond & kc.isNotNull()
    srcs = [s for s in mapped_sources(spec) if s in cols]
    any_src = F.lit(False)
    for s in srcs:
        any_src = any_src | F.col(f"`{s}`").isNotNull()
    return cond & any_src


def entity_route(df: DataFrame, specs: dict[str, dict]) -> Column:
    """Name of the first matching entity by processing order (default 999); null = rejected."""
    ordered = sorted(specs.items(), key=lambda kv: (kv[1].get("entity_processing", {}).get("processing_order", 999),
                                                    kv[0]))
    expr = None
    for name, spec in ordered:
        m = entity_match(df, spec)
        expr = F.when(m, F.lit(name)) if expr is None else expr.when(m, F.lit(name))
    return expr


def entity_envelope(df: DataFrame, entity_type: str, spec: dict, version: str = "1.0") -> DataFrame:
    """``struct(type, data, metadata{created, key_fields, version})``; only mapped fields kept."""
    m = compile_mappings(df, spec)
    return df.select(F.struct(
        F.lit(entity_type).alias("type"),
        F.struct(*[c.alias(n) for n, c in m.items()]).alias("data"),
        F.struct(F.current_timestamp().alias("created"),
                 F.array(*[F.lit(k) for k in spec.get("key_fields", [])]).alias("key_fields"),
                 F.lit(version).alias("version")).alias("metadata"),
    ).alias("entity"))


#: Types whose largest value a hash aggregation can keep in place; others (text, structs) would make Spark sort the rows.
_FIXED_WIDTH = ("tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz", "boolean")


def latest_rows(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows that hold the largest ``order`` value of their key (all of them where it is null throughout; null keys dropped):
    a hash aggregation of these columns and a join sized by the planner, spread by key and value."""
    top = df.groupBy(*[F.col(n).alias(f"_{n}") for n in keys]).agg(F.max(order).alias("__top"))
    same = F.lit(True)
    for n in keys:  # keys first: a merge join then leaves the rows in key order
        same = same & (F.col(n) == F.col(f"_{n}"))
    return df.join(top, same & F.col(order).eqNullSafe(F.col("__top"))).select(*[F.col(f"`{c}`") for c in df.columns])


def extract_entity(df: DataFrame, spec: dict, order_by: Sequence[str] = (), *, reduced: bool = False,
                   fields: Sequence[str] | None = None) -> DataFrame:
    """Distinct entities by key: one row per key (null keys dropped).

    The surviving source record per key is the one with the largest
    ``order_by`` tuple (e.g. latest ``last_modified_date``, then modification
    number), then the largest source record, so the result is fully
    deterministic; it is mapped after the choice.

    The choice has two phases, so that raw rows are never sorted. First the largest value of the leading order column is found
    per key, by a hash aggregation of keys and that one column, and only rows that have it stay (a join sized by the
    planner). Without an order column of fixed width the rows are reduced to their distinct
    records by hash instead. What is left, a few rows a key, is decided by the whole order. Both phases combine
    map-side, so a hot key never ships its raw records to one task, and only the columns the spec reads cross a shuffle.
    With an order column the input is read twice: hand over a table, not an expensive lineage.

    ``reduced`` says that ``df`` went through the first phase already: it holds, of each key, only rows with the largest leading
    order value (or, without order, distinct records); it is read once then. ``fields`` are the entity fields that the
    caller reads (default all). If they are key fields no record has to be chosen, as every record of a key has them: the
    distinct keys are the answer.
    """
    keys = spec["key_fields"]
    m = compile_mappings(df, spec)
    key_names = [k.replace(".", "_") for k in keys]

    def key_expr(k):
        head, _, rest = k.partition(".")
        c = m[head] if head in m else F.col(f"`{head}`")
        for part in rest.split(".") if rest else []:
            c = c.getField(part)
        return c

    srcs = [c for c in spec_sources(spec) if c in df.columns]
    internal = [f"__k{i}" for i in range(len(keys))]
    orders = [f"__ord{i}" for i in range(len(order_by))]
    held = [f"__s{i}" for i in range(len(srcs))]
    if fields is not None and set(fields) <= {k for k in keys if "." not in k}:
        present = df.select(*[key_expr(k).alias(n) for k, n in zip(keys, internal)])
        for n in internal:
            present = present.where(F.col(n).isNotNull())
        return present.distinct().select(*[F.col(internal[keys.index(f)]).alias(f) for f in fields])
    by_order = bool(orders) and dict(df.dtypes)[order_by[0]] in _FIXED_WIDTH
    if not by_order and not reduced:  # before any key is computed
        heads = [k.partition(".")[0] for k in keys]
        needed = [f"`{c}`" for c in dict.fromkeys([*srcs, *order_by, *heads]) if c in df.columns]
        # a distinct under a max would be optimised away; the count keeps it
        df = df.groupBy(*needed).agg(F.count(F.lit(1)).alias("__times")).where(F.col("__times") > 0).drop("__times")
    pre = df.select(*[key_expr(k).alias(n) for k, n in zip(keys, internal)],
                    *[F.col(f"`{o}`").alias(n) for o, n in zip(order_by, orders)],
                    *[F.col(f"`{c}`").alias(n) for c, n in zip(srcs, held)])
    nonnull = F.lit(True)
    for n in internal:
        nonnull = nonnull & F.col(n).isNotNull()
    pre = pre.where(nonnull)
    if by_order and not reduced:
        pre = latest_rows(pre, internal, orders[0])
    record = F.struct(*[F.col(n).alias(c) for c, n in zip(srcs, held)]).alias("__src")
    best = F.max(F.struct(*[F.col(n) for n in orders], record))
    rows = pre.groupBy(*internal).agg(best.alias("_m")).select(*internal, "_m.__src.*")
    with warnings.catch_warnings():  # absent sources were reported on the first mapping
        warnings.simplefilter("ignore")
        mapped = compile_mappings(rows.drop(*internal), spec)
    flat_keys = [(i, n) for (k, n), i in zip(zip(keys, key_names), internal) if "." not in k and n not in mapped]
    out = rows.select(*[F.col(i).alias(n) for i, n in flat_keys], *[c.alias(n) for n, c in mapped.items()])
    return out if fields is None else out.select(*[F.col(f"`{f}`") for f in fields])


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs -> flat columns ``a_b_c`` (for reports and SQL checks)."""
    def walk(dt, path):
        from pyspark.sql.types import StructType
        if isinstance(dt, StructType):
            for f in dt.fields:
                yield from walk(f.dataType, path + [f.name])
        else:
            yield path
    cols = []
    for f in df.schema.fields:
        for p in walk(f.dataType, [f.name]):
            cols.append(F.col(".".join(f"`{x}`" for x in p)).alias(sep.join(p)))
    return df.select(*cols)


def dot_path_read(c, path: str, json: bool = False) -> Column:
    """Value at ``a.b.c`` in a struct column, or in a JSON text column; any
    missing step gives null."""
    if json:
        return F.get_json_object(c if isinstance(c, Column) else F.col(c), "$." + path)
    base = c if isinstance(c, Column) else F.col(c)
    for part in path.split("."):
        base = base.getField(part)
    return base


def dot_path_write(assignments: dict[str, Column]) -> list[Column]:
    """Build nested structs from dotted target names (``{"a.b": col}``)."""
    tree: dict = {}
    for path, col in assignments.items():
        node = tree
        parts = path.split(".")
        for p in parts[:-1]:
            node = node.setdefault(p, {})
        node[parts[-1]] = col

    def build(node):
        return F.struct(*[(build(v) if isinstance(v, dict) else v).alias(k) for k, v in node.items()])
    return [(build(v) if isinstance(v, dict) else v).alias(k) for k, v in tree.items()]


def resolve_patterns(columns: Iterable[str], rules: Sequence[tuple[str, Sequence[str]]]) -> dict[str, str]:
    """Column -> rule name. ``rules`` is an ordered list of (rule name,
    field names or wildcard patterns). An explicit name beats any pattern;
    among explicit names, and among patterns, the first listed wins."""
    out: dict[str, str] = {}
    cols = list(columns)
    for name, fields in rules:
        for f in fields:
            if not any(ch in f for ch in "*?[") and f in cols:
                out.setdefault(f, name)
    for name, fields in rules:
        for f in fields:
            if any(ch in f for ch in "*?["):
                for c in fnmatch.filter(cols, f):
                    out.setdefault(c, name)
    return out


MONEY_NAME_HINTS = ("amount", "price", "cost", "value")


def money_by_name(columns: Iterable[str]) -> list[str]:
    """P9 (opt-in): columns whose name says money (amount/price/cost/value)."""
    return [c for c in columns if any(h in c.lower() for h in MONEY_NAME_HINTS)]


def select_fields(df: DataFrame, fields: dict[str, dict]) -> DataFrame:
    """Keep the defined fields present in ``df``; required fields and
    everything they depend on (transitively) must be present; required first."""
    def deps(name, seen):
        for d in fields.get(name, {}).get("dependencies", []) or []:
            if d in seen:
                continue
            seen.add(d)
            deps(d, seen)
        return seen
    required = [n for n, f in fields.items() if f.get("required")]
    needed: set[str] = set(required)
    for r in required:
        needed |= deps(r, set())
    missing = sorted(n for n in needed if n not in df.columns)
    if missing:
        raise ValueError(f"required fields (or their dependencies) missing: {missing}")
    optional = [n for n in fields if n not in required and n in df.columns]
    return df.select(*[F.col(f"`{n}`") for n in required + optional])


def require_fields(df: DataFrame, names: Sequence[str]) -> Column:
    """Column-presence check (raises) + row-level predicate (all not null)."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"required source fields missing: {missing}")
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(f"`{n}`").isNotNull()
    return cond
