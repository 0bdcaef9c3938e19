"""Entity mapping, routing, extraction and relationships on small fixtures."""

import warnings

import pytest
from pyspark.sql import functions as F

from fedlake.operators import derive, mapping, relations

SPEC = {
    "key_fields": ["id"],
    "field_mappings": {
        "direct": {"id": "field1", "missing": "not_a_column"},
        "multi_source": {"code": {"sources": ["a", "b"], "strategy": "first_non_empty"}},
        "object": {"contact": {"type": "object", "fields": {"phone": "field2", "type": "primary"}}},
        "reference": {"ref": {"entity": "x", "key_prefix": "p", "key_fields": ["c1", "c2"]}},
        "template": {"t": {"type": "object", "fields": {"o": {"type": "template",
                                                              "templates": {"k": "{a}:{field1}"}}}}},
    },
}


def _rec(spark):
    return spark.createDataFrame([("r1", "100", " ", "B1", "u", None, "A1"), ("r2", "200", "A2", "B2", None, None, None)],
                                 "field1 string, field2 string, a string, b string, p_c1 string, p_c2 string, c string")


def test_compile_all_mapping_kinds(spark):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        out = mapping.map_entity(_rec(spark), SPEC).orderBy("id").collect()
    r1 = out[0]
    assert r1.missing is None
    assert r1.code == "B1"                       # blank first source skipped
    assert r1.contact.phone == "100" and r1.contact.type == "primary"  # constant kept
    assert r1.ref.key == "u:"                    # positions kept for missing parts
    assert r1.t.o.k == " :r1"
    assert out[1].code == "A2"


def test_template_null_part_gives_null(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    assert df.select(mapping.map_template(df, "{a}:{b}").alias("t")).first().t is None


def test_route_first_match_by_order(spark):
    df = spark.createDataFrame([("k1", None), (None, "k2"), (None, None)], "x string, y string")
    specs = {"second": {"key_fields": ["x2"], "field_mappings": {"direct": {"x2": "x"}},
                        "entity_processing": {"processing_order": 2}},
             "first": {"key_fields": ["y2"], "field_mappings": {"direct": {"y2": "y"}},
                       "entity_processing": {"processing_order": 1}}}
    assert [r.t for r in df.select(mapping.entity_route(df, specs).alias("t")).collect()] == ["second", "first", None]


def test_extract_latest_deterministic(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 3, "new"), ("k", 3, "newer"), (None, 9, "x")],
                               "key string, ts int, v string")
    spec = {"key_fields": ["key"], "field_mappings": {"direct": {"key": "key", "v": "v"}}}
    out = mapping.extract_entity(df, spec, order_by=["ts"]).collect()
    assert [(r.key, r.v) for r in out] == [("k", "newer")]


def test_select_fields_dependency_closure(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    fields = {"a": {"required": True, "dependencies": ["c"]}, "b": {}}
    with pytest.raises(ValueError):
        mapping.select_fields(df, fields)
    assert mapping.select_fields(df, {"b": {}, "a": {"required": True}}).columns == ["a", "b"]


def test_wildcards_explicit_wins():
    cols = ["awarding_office_code", "funding_office_code", "recipient_name", "x_indicator"]
    got = mapping.resolve_patterns(cols, [("upper", ["*_name"]), ("code", ["*_code"]), ("office", ["awarding_office_code"]),
                                          ("yn", ["*_indicator", "*"])])
    assert got == {"awarding_office_code": "office", "funding_office_code": "code", "recipient_name": "upper",
                   "x_indicator": "yn"}


def test_derived_calculations(spark):
    df = spark.createDataFrame([("100", "200", "Hello", "World")], "field1 string, field2 string, s1 string, s2 string")
    derive.register_calculation("multiply", lambda cols, **p: cols[0] * cols[1])
    out = derive.derive_fields(df, {
        "total": {"type": "sum", "sources": ["field1", "field2"]},
        "joined": {"type": "concat", "sources": ["s1", "s2"], "separator": "-"},
        "prod": {"type": "custom", "function": "multiply", "sources": [F.lit(10), F.lit(20)]},
    }).first()
    assert float(out.total) == 300.0 and out.joined == "Hello-World" and out.prod == 200
    with pytest.raises(KeyError):
        derive.calculate("no_such_calc", ["field1"])
    with pytest.raises(ValueError):
        derive.derive_formula(["field1"], "__import__('os')")


def test_self_parent_edges(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 9)], "k int, p int")
    out = sorted((r.child_id, r.parent_id, r.parent_found) for r in relations.self_parent_edges(df, "k", "p").collect())
    assert out == [(2, 1, True), (3, 9, False)]


def test_cardinality(spark):
    e = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "src_id string, dst_id string")
    assert relations.cardinality(e).first().observed == "many_to_one"


def test_chunked_collect_splits_hot_parent(spark):
    df = spark.range(0, 2500).select(F.lit("hot").alias("p"), F.col("id"))
    out = relations.chunked_collect(df, ["p"], F.col("id"), "id", chunk_size=1000).collect()
    assert len(out) == 3 and sum(r.n_items for r in out) == 2500
    assert sorted(x for r in out for x in r["items"]) == list(range(2500))


def test_find_path():
    defs = [{"id": "t2c", "sourceEntity": "transaction", "targetEntity": "contract"},
            {"id": "c2a", "sourceEntity": "contract", "targetEntity": "agency"}]
    assert [d["id"] for d in relations.find_path(defs, "transaction", "agency")] == ["t2c", "c2a"]
    assert relations.check_definition({"id": "h", "relationshipType": "hierarchical", "cardinality": "one_to_one"})


def test_role_edges_and_resolution(spark):
    c = spark.createDataFrame([("c1", "a:1", "a:9", None), ("c2", "a:1", None, None)],
                              "id string, aw string, fu string, pa string")
    edges = relations.role_edges(c, "contract", "id", {"awarding": F.col("aw"), "funding": F.col("fu"),
                                                       "parent_award": F.col("pa")}, "agency",
                                 "contract_to_{role}_agency")
    agencies = spark.createDataFrame([("a:1",)], "agency_key string")
    got = sorted((r.src_id, r.rel, r.dst_id, r.dst_found)
                 for r in relations.resolve_edges(edges, agencies, "agency_key").collect())
    assert got == [("c1", "contract_to_awarding_agency", "a:1", True),
                   ("c1", "contract_to_funding_agency", "a:9", False),
                   ("c2", "contract_to_awarding_agency", "a:1", True)]


def test_reference_without_parts_and_constants(spark):
    from fedlake.operators import mapping as M
    df = spark.createDataFrame([(None, None), ("a", None)], "x string, y string")
    keys = [r.k for r in df.select(M.map_reference(df, {"entity": "e", "key_fields": ["x", "y"]})["key"].alias("k")).collect()]
    assert keys == [None, "a:"]
    o = df.select(M.map_object(df, {"fields": {"kind": "not_applicable", "x": "x", "gone": {"field": "z"}}}).alias("o")).first().o
    assert o.kind == "not_applicable" and o.gone is None


def test_required_derived_field(spark):
    import pytest
    from fedlake.operators.derive import derive_fields
    df = spark.createDataFrame([(None, None)], "a string, b string")
    spec = {"c": {"type": "first_non_null", "sources": ["a", "b"], "required": True}}
    assert derive_fields(df, spec, on_missing="flag").first().missing_fields == ["c"]
    with pytest.raises(Exception, match="required field c"):
        derive_fields(df, spec).collect()


def test_declared_source_column_that_is_lost_is_a_typed_null(spark):
    df = spark.createDataFrame([("k1", "A")], "key string, kind string")
    spec = {"key_fields": ["key"], "source_columns": {"price_code": "int", "kind": "string"},
            "field_mappings": {"direct": {"key": "key"},
                               "object": {"o": {"fields": {"code": "price_code", "kind": "kind", "role": "primary"}}}}}
    mapping.MISSING_SOURCES.discard("price_code")
    with pytest.warns(UserWarning, match="price_code"):
        out = mapping.extract_entity(df, spec)
    assert dict(out.dtypes)["o"] == "struct<code:int,kind:string,role:string>"
    assert out.first().o.asDict() == {"code": None, "kind": "A", "role": "primary"}
    names = {**spec, "source_columns": ["price_code"]}     # a list of names: text
    assert dict(mapping.extract_entity(df, names).dtypes)["o"].startswith("struct<code:string")
