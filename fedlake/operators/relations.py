"""Relationships between entities.

Edges are plain DataFrames ``(src_type, src_id, rel, dst_type, dst_id, role)``;
relationship definitions are driver-side metadata. Every join here is an
equi-join on entity keys, size-checked before any broadcast.

Collections of related entities (J10, J12) are built with ``chunked_collect``:
a parent's children are split into chunks of at most about ``chunk_size``
items (by a hash of the child key), so a parent holding a third of all rows
yields many bounded rows instead of one giant array in one task.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .joins import join_small

DEFAULT_CHUNK = 10_000


def reference_edges(src: DataFrame, src_type: str, src_key: str, ref_key: Column, dst_type: str, rel: str,
                    role: str | None = None) -> DataFrame:
    """Edges from an entity's reference field (null references dropped)."""
    return src.select(F.lit(src_type).alias("src_type"), F.col(src_key).cast("string").alias("src_id"),
                      F.lit(rel).alias("rel"), F.lit(dst_type).alias("dst_type"),
                      ref_key.cast("string").alias("dst_id"), F.lit(role).cast("string").alias("role")) \
        .where(F.col("dst_id").isNotNull())


def role_edges(src: DataFrame, src_type: str, src_key: str, refs: dict[str, Column], dst_type: str,
               rel: str = "{role}") -> DataFrame:
    """Edges for several reference roles of one entity in a single pass
    (one row per role via ``explode``; null references dropped)."""
    roles = F.array(*[F.struct(F.lit(r).alias("role"), c.cast("string").alias("dst_id")) for r, c in refs.items()])
    ex = src.select(F.col(src_key).cast("string").alias("src_id"), F.explode(roles).alias("_r"))
    return ex.where(F.col("_r.dst_id").isNotNull()).select(
        F.lit(src_type).alias("src_type"), "src_id",
        F.format_string(rel.replace("{role}", "%s"), F.col("_r.role")).alias("rel") if "{role}" in rel
        else F.lit(rel).alias("rel"),
        F.lit(dst_type).alias("dst_type"), F.col("_r.dst_id").alias("dst_id"), F.col("_r.role").alias("role"))


def resolve_edges(edges: DataFrame, targets: DataFrame, target_key: str) -> DataFrame:
    """Many-to-one resolution: each edge gets ``dst_found`` (left join on the key)."""
    t = targets.select(F.col(target_key).cast("string").alias("__tk")).distinct()
    return join_small(edges, t.withColumn("dst_found", F.lit(True)), F.col("dst_id") == F.col("__tk"), "left") \
        .withColumn("dst_found", F.coalesce("dst_found", F.lit(False))).drop("__tk")


def hierarchy_pairs(parent: DataFrame, child: DataFrame, parent_key: Sequence[str],
                    child_parent_key: Sequence[str]) -> DataFrame:
    """Parent x child on the composite key (child carries its parent's key)."""
    cond = None
    for pk, ck in zip(parent_key, child_parent_key):
        c = F.col(pk) == F.col(ck)
        cond = c if cond is None else cond & c
    return join_small(child, parent, cond, "inner")


def self_parent_edges(df: DataFrame, key: str, parent_key: str) -> DataFrame:
    """child_of edges from a self reference; self-loops dropped; parent
    presence flagged (left join of the entity with its own key set)."""
    edges = df.where(F.col(parent_key).isNotNull() & (F.col(parent_key) != F.col(key))) \
        .select(F.col(key).alias("child_id"), F.col(parent_key).alias("parent_id")).distinct()
    keys = df.select(F.col(key).alias("__pid")).distinct().withColumn("parent_found", F.lit(True))
    return join_small(edges, keys, F.col("parent_id") == F.col("__pid"), "left") \
        .withColumn("parent_found", F.coalesce("parent_found", F.lit(False))).drop("__pid")


def both_directions(edges: DataFrame) -> DataFrame:
    """Edges plus their inverses (src/dst swapped), distinct by type pair."""
    fwd = edges.select("src_type", "dst_type", F.col("rel"), F.lit("forward").alias("direction"))
    inv = edges.select(F.col("dst_type").alias("src_type"), F.col("src_type").alias("dst_type"),
                       F.col("rel"), F.lit("inverse").alias("direction"))
    return fwd.unionByName(inv).distinct()


def cardinality(edges: DataFrame, src: str = "src_id", dst: str = "dst_id") -> DataFrame:
    """Observed cardinality of an edge set.

    Max distinct partners per source and per target come from two partial
    aggregations (distinct pairs first), then one row: ``one_to_one``,
    ``one_to_many``, ``many_to_one`` or ``many_to_many``.
    """
    pairs = edges.select(src, dst).where(F.col(src).isNotNull() & F.col(dst).isNotNull()).distinct()
    per_src = pairs.groupBy(src).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("max_dst_per_src"))
    per_dst = pairs.groupBy(dst).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("max_src_per_dst"))
    none = F.lit(None).cast("long")
    out = (per_src.select("max_dst_per_src", none.alias("max_src_per_dst"))
           .unionByName(per_dst.select(none.alias("max_dst_per_src"), "max_src_per_dst"))
           .agg(F.max("max_dst_per_src").alias("max_dst_per_src"), F.max("max_src_per_dst").alias("max_src_per_dst")))
    many_dst = F.coalesce(F.col("max_dst_per_src"), F.lit(0)) > 1
    many_src = F.coalesce(F.col("max_src_per_dst"), F.lit(0)) > 1
    kind = (F.when(~many_src & ~many_dst, "one_to_one").when(~many_src & many_dst, "one_to_many")
            .when(many_src & ~many_dst, "many_to_one").otherwise("many_to_many"))
    return out.withColumn("observed", kind)


def cardinality_allows(declared: str) -> list[str]:
    """Observed kinds a declared cardinality accepts (a 1:n relation may hold 1:1 data)."""
    return {"one_to_one": ["one_to_one"], "one_to_many": ["one_to_one", "one_to_many"],
            "many_to_one": ["one_to_one", "many_to_one"],
            "many_to_many": ["one_to_one", "one_to_many", "many_to_one", "many_to_many"]}[declared]


def check_definition(defn: dict) -> list[str]:
    """J8 (driver): definition rules — hierarchical must be 1:n or n:1; a
    self reference must be flagged."""
    problems = []
    if defn.get("relationshipType") == "hierarchical" and defn.get("cardinality") not in ("one_to_many",
                                                                                         "many_to_one"):
        problems.append(f"{defn.get('id')}: hierarchical relationship must be one_to_many or many_to_one")
    if defn.get("sourceEntity") == defn.get("targetEntity") and not defn.get("self_reference", True):
        problems.append(f"{defn.get('id')}: self reference not allowed")
    return problems


def find_path(definitions: Sequence[dict], start: str, goal: str) -> list[dict]:
    """J9 (driver): shortest relationship path between entity types (BFS over
    definitions, both directions)."""
    adj: dict[str, list[tuple[str, dict, bool]]] = {}
    for d in definitions:
        adj.setdefault(d["sourceEntity"], []).append((d["targetEntity"], d, True))
        adj.setdefault(d["targetEntity"], []).append((d["sourceEntity"], d, False))
    prev: dict[str, tuple[str, dict, bool] | None] = {start: None}
    q = deque([start])
    while q:
        cur = q.popleft()
        if cur == goal:
            break
        for nxt, d, fwd in adj.get(cur, []):
            if nxt not in prev:
                prev[nxt] = (cur, d, fwd)
                q.append(nxt)
    if goal not in prev:
        raise ValueError(f"no relationship path from {start} to {goal}")
    path = []
    node = goal
    while prev[node] is not None:
        cur, d, fwd = prev[node]
        path.append({**d, "_forward": fwd})
        node = cur
    return list(reversed(path))


def join_path(start: DataFrame, hops: Sequence[tuple[DataFrame, str, str]], how: str = "inner") -> DataFrame:
    """Follow a path as a chain of equi-joins ``(table, left_key, right_key)``."""
    out = start
    for table, lk, rk in hops:
        out = join_small(out, table, F.col(lk) == F.col(rk), how)
    return out


def chunked_collect(df: DataFrame, parent: Sequence[str], item: Column, sort_key: str,
                    chunk_size: int = DEFAULT_CHUNK, alias: str = "items") -> DataFrame:
    """Per parent, the sorted list of its child items, as chunk rows.

    Output rows ``(parent..., chunk, n_items, items)``: a parent has one row per
    ``chunk_size`` children, numbered from 0; read in chunk order the lists are
    the whole sorted list. Rows are range-sorted by (parent, sort_key) and cut by
    position, so a parent (or a repeated key) of any size is spread over tasks
    and no list is longer than ``chunk_size``. All children are kept.
    """
    from .summary import with_position

    parent = list(parent)
    rows = df.select(*parent, F.col(sort_key).alias("__k"), item.alias("__v"))
    placed, _ = materialize(with_position(rows, [*((p, True) for p in parent), ("__k", True)], "__pos"), "positions")
    starts = placed.groupBy(*parent).agg(F.min("__pos").alias("__first"))
    cond = F.lit(True)
    for p in parent:
        cond = cond & F.col(f"r.{p}").eqNullSafe(F.col(f"s.{p}"))
    joined = join_small(placed.alias("r"), starts.alias("s"), cond, "inner", materialize=False)
    at = F.col("__pos") - F.col("__first")
    chunked = joined.select(*[F.col(f"r.{p}").alias(p) for p in parent],
                            F.floor(at / chunk_size).cast("long").alias("chunk"), "__pos", "__v")
    lists = chunked.groupBy(*parent, "chunk").agg(
        F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list(F.struct("__pos", "__v"))).alias("__l"))
    return lists.select(*parent, "chunk", "n_items", F.transform("__l", lambda x: x["__v"]).alias(alias))


def hierarchy_levels(definitions: Sequence[dict], root: str) -> list[str]:
    """J12 (driver): the chain of entities that hierarchical one-to-many definitions declare below ``root``."""
    below = {d["sourceEntity"]: d["targetEntity"] for d in definitions
             if d.get("relationshipType") == "hierarchical" and d.get("cardinality") == "one_to_many"
             and d["sourceEntity"] != d["targetEntity"]}
    chain = [root]
    while chain[-1] in below and below[chain[-1]] not in chain:
        chain.append(below[chain[-1]])
    return chain


def nest(df: DataFrame, levels: Sequence[tuple[str, Sequence[str]]], chunk_size: int = 1_000) -> DataFrame:
    """Nested lists over any number of levels.

    ``levels``: (list name, columns) from the outermost entity inwards; the first column of a level is its key. Each
    entity holds the sorted list of the next level's entities under that level's name, merged once however many
    rows name it. A list longer than ``chunk_size`` continues in further entries of its parent with the next ``chunk``.
    """
    inner = df.select(*[c for _, cols in levels for c in cols]).distinct()
    payload: list[str] = []
    for depth in range(len(levels) - 1, 0, -1):
        name, cols = levels[depth]
        outer = [c for _, cs in levels[:depth] for c in cs]
        item = F.struct(*cols, *payload)
        inner = chunked_collect(inner, outer, item, cols[0], chunk_size, alias=name).drop("n_items")
        inner = inner.withColumnRenamed("chunk", f"{name}_chunk")
        payload = [f"{name}_chunk", name]
    return inner
