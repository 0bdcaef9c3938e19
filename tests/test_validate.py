"""Rule engine: the rule-set fixtures, dependent groups, severities, policies."""

import pytest
from pyspark.sql import functions as F

from fedlake.operators import validate as V

RULES = [
    {"field": "name", "type": "required", "id": "name_required"},
    {"field": "email", "type": "pattern", "params": {"pattern": r"^[\w\.-]+@[\w\.-]+\.\w+$"}, "id": "email"},
    {"field": "street", "type": "required", "id": "street_required"},
    {"field": "postal_code", "type": "pattern", "params": {"pattern": r"^\d{5}(?:-\d{4})?$"}, "severity": "warning",
     "id": "postal"},
]


def _people(spark):
    return spark.createDataFrame([
        ("good", "John Doe", "john@example.com", "123 Main St", "12345-6789"),
        ("bad", "  ", "invalid-email", "", "invalid"),
    ], "k string, name string, email string, street string, postal_code string")


def test_collect_all_violations(spark):
    out = {r.k: r.ids for r in V.validate(_people(spark), RULES).select("k", V.violation_ids().alias("ids")).collect()}
    assert out["good"] == ""
    assert out["bad"] == "name_required,email,street_required,postal"


def test_disabled_rules_and_first_only(spark):
    rules = [dict(r, enabled=False) for r in RULES]
    assert V.validate(_people(spark), rules).where(F.size("violations") > 0).count() == 0
    first = V.validate(_people(spark), RULES, first_only=True).where(F.col("k") == "bad").first()
    assert len(first.violations) == 1


def test_dependent_group_runs_only_when_base_passes(spark):
    df = spark.createDataFrame([("",), ("12a",), ("42",)], "id string")
    rules = [{"field": "id", "type": "required", "group": "base"},
             {"field": "id", "type": "pattern", "params": {"pattern": r"^\d+$"}, "group": "fmt"}]
    out = [r.n for r in V.validate(df, rules, groups={"fmt": {"dependencies": ["base"]}})
           .select(F.size("violations").alias("n")).collect()]
    assert out == [1, 1, 0]


def test_group_cycle_rejected(spark):
    df = spark.createDataFrame([("x",)], "id string")
    with pytest.raises(ValueError):
        V.validate(df, [{"field": "id", "type": "required", "group": "a"}],
                   groups={"a": {"dependencies": ["b"]}, "b": {"dependencies": ["a"]}})


def test_range_severity_policy(spark):
    df = spark.createDataFrame([(10,), (130,), (None,)], "age int")
    v = V.validate(df, [{"field": "age", "type": "range", "params": {"min": 0, "max": 120}}])
    assert v.where(V.is_valid()).count() == 2
    with pytest.raises(ValueError):
        V.apply_error_policy(v, "abort")
    assert V.apply_error_policy(v, "skip").count() == 2
    assert V.apply_error_policy(v, "log").count() == 3


def test_message_template(spark):
    df = spark.createDataFrame([(5.0, 3.0)], "a double, b double")
    rule = {"field": "a", "type": "compare", "params": {"operator": "<=", "compare_to": "b"},
            "message": "Field {field} must be {operator} {compare_to} (was {value})"}
    msg = V.validate(df, [rule]).first().violations[0].message
    assert msg == "Field a must be <= b (was 5.0)"


def test_compare_null_side_passes_and_equal_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 2.0)], "a double, b double")
    le = V.validate(df, [{"field": "a", "type": "compare", "params": {"operator": "<=", "compare_to": "b"}}])
    lt = V.validate(df, [{"field": "a", "type": "compare", "params": {"operator": "<", "compare_to": "b"}}])
    assert [len(r.violations) for r in le.collect()] == [0, 0]
    assert [len(r.violations) for r in lt.collect()] == [0, 1]


def test_stats(spark):
    st = V.validation_stats(V.validate(_people(spark), RULES)).first()
    assert (st.records, st.valid_records, st.invalid_records, st.n_warning, st.n_error) == (2, 1, 1, 1, 3)


def test_policy_counts_only_the_entitys_fields(spark):
    out = V.validate(_people(spark), RULES)
    assert V.apply_error_policy(out, "skip", fields=["name"]).count() == 1
    assert V.apply_error_policy(out, "abort", fields=["k"]).count() == 2
    with pytest.raises(ValueError):
        V.apply_error_policy(out, "abort", fields=["email"])


def test_group_error_level_and_null_condition(spark):
    df = spark.createDataFrame([(None, 5), (True, 5)], "c boolean, v int")
    rule = {"field": "v", "type": "conditional", "group": "g", "params": {"when": "c", "rule": {"type": "range", "params": {"max": 1}}}}
    a, b = V.validate(df, [rule], groups={"g": {"error_level": "warning"}}).collect()
    assert a.violations == [] and [v.severity for v in b.violations] == ["warning"]


def test_conversion_counts_errors_in_its_one_write(spark, tmp_path):
    from fedlake.plans.conversion import convert
    from fedlake.sources import store

    df = spark.createDataFrame([("k1", "A", 1), ("k1", "A", 1), ("k2", "X", 2), (None, "X", 3), ("k3", None, 4)],
                               "key string, kind string, n int")
    rules = [{"field": "kind", "type": "enum", "params": {"values": ["A"]}}]

    def entities(policy, **options):
        return {"thing": {"key_fields": ["key"], "field_mappings": {"direct": {"key": "key", "kind": "kind"}},
                          "entity_processing": {"processing_options": {"error_handling": policy, **options}}},
                "other": {"key_fields": ["n"], "field_mappings": {"direct": {"n": "n"}}}}

    held, root = str(tmp_path / "held"), str(tmp_path / "store")
    with pytest.raises(ValueError, match="thing: 1 invalid"):
        convert(spark, df, entities("abort"), rules=rules, store_root=root, quarantine=held)
    assert not (tmp_path / "store").exists()               # no entity is stored, earlier ones neither
    assert [(r.key, r.n, r.invalid_for) for r in spark.read.parquet(held).collect()] == [("k2", 2, ["thing"])]
    out = convert(spark, df, entities("abort", max_errors=1), rules=rules)
    assert sorted(r.key for r in out["thing"].collect()) == ["k1", "k2", "k3"] and out["other"].count() == 4
    out = convert(spark, df, entities("abort"), rules=rules, on_error="skip", store_root=root, quarantine=held)
    assert sorted(r.key for r in out["thing"].collect()) == ["k1", "k3"]
    assert {r.entity_type: r.n for r in store.count_entities(spark, root).collect()} == {"thing": 2, "other": 4}
    assert spark.read.parquet(held).count() == 1           # replaced
    out = convert(spark, df.limit(0), entities("abort"), rules=rules, quarantine=held)
    assert out["thing"].isEmpty() and spark.read.parquet(held).isEmpty()


def test_records_in_parts_and_slices_give_the_same_entities(spark, monkeypatch):
    from fedlake import session
    from fedlake.plans.conversion import convert
    from fedlake.session import scratch_path
    from fedlake.sources import store

    rows = [(f"k{i % 40}" if i % 9 else None, i % 7, f"v{i}") for i in range(400)]
    schema = "k string, d int, v string"
    spec = {"key_fields": ["k"], "order_by": ["d"], "field_mappings": {"direct": {"k": "k", "v": "v", "d": "d"}},
            "entity_processing": {"processing_options": {"error_handling": "abort", "max_errors": 51}}}
    rules = [{"field": "v", "type": "enum", "params": {"values": [r[2] for r in rows[:340]]}}]
    whole, sliced = scratch_path(spark, "t-whole"), scratch_path(spark, "t-sliced")
    df = spark.createDataFrame(rows, schema)
    one = convert(spark, df, {"thing": spec}, rules=rules, store_root=whole, max_errors=60)["thing"]
    monkeypatch.setattr(session, "SLICE_BYTES", 1000)
    parts = [spark.createDataFrame(p, schema) for p in (rows[:150], rows[150:151], rows[151:])]
    batches, real = [], store.upsert
    monkeypatch.setattr(store, "upsert", lambda s, new, root: batches.append(len(new)) or real(s, new, root))
    out = convert(spark, parts, {"thing": spec}, rules=rules, store_root=sliced, max_errors=60)["thing"]
    assert batches[0] > 2 and out.columns == one.columns == ["k", "v", "d"]
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, one.collect())) and out.count() == 40
    ids = [sorted(r.id for r in store.read_store(spark, root).collect()) for root in (whole, sliced)]
    assert ids[0] == ids[1] and len(ids[0]) == 40
    with pytest.raises(ValueError, match="thing: 53 invalid"):  # of the records with a key, counted over all parts
        convert(spark, parts, {"thing": spec}, rules=rules, max_errors=52)
