"""Entity store queries (S7-S12) on customers written as recipient entities."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import load, scratch_path
from ..sources import store
from .catalog import register

RECIPIENT_SCHEMA = T.StructType([T.StructField("c_acctbal", T.DoubleType()),
                                 T.StructField("c_custkey", T.LongType()),
                                 T.StructField("c_mktsegment", T.StringType()),
                                 T.StructField("c_name", T.StringType())])


def _recipients(spark, sf_dir):
    return load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def _fresh_store(spark, sf_dir, name):
    """Write every customer as a recipient entity into a new store folder."""
    root = scratch_path(spark, f"{name}-store")
    store.upsert(spark, store.to_store_rows(_recipients(spark, sf_dir), "recipient"), root)
    return root


@register("content_id_upsert",
          "SELECT c_custkey, c_acctbal FROM customer UNION ALL "
          "SELECT c_custkey, c_acctbal + 1 FROM customer WHERE c_mktsegment = 'AUTOMOBILE'")
def q_content_id_upsert(spark, sf_dir):
    """Content ids + upsert. A second batch re-sends the BUILDING customers
    unchanged (same content, same id: replaced, not duplicated) and changed
    AUTOMOBILE customers (new content, new ids: added)."""
    root = _fresh_store(spark, sf_dir, "upsert")
    rec = _recipients(spark, sf_dir)
    batch2 = (rec.where(F.col("c_mktsegment") == "BUILDING")
              .unionByName(rec.where(F.col("c_mktsegment") == "AUTOMOBILE")
                           .withColumn("c_acctbal", F.col("c_acctbal") + 1)))
    store.upsert(spark, store.to_store_rows(batch2, "recipient"), root)
    return store.list_entities(spark, root, "recipient", RECIPIENT_SCHEMA).select("c_custkey", "c_acctbal")


@register("entity_store_layout",
          "SELECT 'recipient' AS entity_type, CAST(count(*) AS BIGINT) AS n FROM customer")
def q_entity_store_layout(spark, sf_dir):
    """S7 + S12: recipients written by (type, shard) partitions; counted back per type."""
    return store.count_entities(spark, _fresh_store(spark, sf_dir, "layout"))


@register("entity_count",
          "SELECT 'recipient' AS entity_type, CAST(count(*) AS BIGINT) AS n FROM customer UNION ALL "
          "SELECT 'supplier_office', CAST(count(*) AS BIGINT) FROM supplier")
def q_entity_count(spark, sf_dir):
    """Entities per type across two types in one store."""
    root = _fresh_store(spark, sf_dir, "count")
    sup = load(spark, sf_dir, "supplier")
    store.upsert(spark, store.to_store_rows(sup, "supplier_office"), root)
    return store.count_entities(spark, root)


@register("entity_get",
          "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey = 7")
def q_entity_get(spark, sf_dir):
    """Point lookup by (type, id) with partition pruning and strict decoding."""
    root = _fresh_store(spark, sf_dir, "get")
    rec = _recipients(spark, sf_dir).where(F.col("c_custkey") == 7)
    wanted = rec.select(store.content_id(rec).alias("id")).first()  # the id a caller would hold
    entity_id = wanted["id"] if wanted else "0" * 64
    out = store.get_entity(spark, root, "recipient", entity_id, RECIPIENT_SCHEMA)
    return out.select("entity.c_custkey", "entity.c_name", "entity.c_acctbal")


@register("entity_delete",
          "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment <> 'MACHINERY'")
def q_entity_delete(spark, sf_dir):
    """Delete the MACHINERY customers by id; the rest remain."""
    root = _fresh_store(spark, sf_dir, "delete")
    rec = _recipients(spark, sf_dir).where(F.col("c_mktsegment") == "MACHINERY")
    report = store.delete_entities(spark, root, "recipient", rec.select(store.content_id(rec).alias("id")))
    r = report.first()
    if r["requested"] != r["deleted"]:
        raise AssertionError(f"delete removed {r['deleted']} of {r['requested']} ids")
    return store.list_entities(spark, root, "recipient", RECIPIENT_SCHEMA).select("c_custkey", "c_name")


@register("entity_list",
          "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def q_entity_list(spark, sf_dir):
    """List one type's entities, decoded."""
    root = _fresh_store(spark, sf_dir, "list")
    return store.list_entities(spark, root, "recipient", RECIPIENT_SCHEMA).drop("id")
