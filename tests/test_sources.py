"""File sources and sinks on small written fixtures."""

import gzip
import json
import zipfile

import pytest
from pyspark.sql import types as T

from fedlake.sources import files, sinks


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_scan_csv_traps(spark, tmp_path):
    p = tmp_path / "awards.csv"
    _write(p, '﻿code,name,amount\n015,"ACME, ""THE"" INC",$1.00\n016,short\n017,long,$2,extra\n',
           encoding="utf-8")
    df = files.scan_csv(spark, str(p), flag_corrupt=True)
    rows = {r.code: r for r in df.collect()}
    assert df.columns[:3] == ["code", "name", "amount"]          # BOM stripped
    assert rows["015"].name == 'ACME, "THE" INC'                   # doubled quotes, comma kept
    assert rows["016"].amount is None and rows["016"][files.CORRUPT] is None   # short row is valid
    assert rows["017"][files.CORRUPT] is not None                  # long row flagged


def test_scan_csv_header_only_and_missing_header(spark, tmp_path):
    p = tmp_path / "h.csv"
    _write(p, "a,b\n")
    assert files.scan_csv(spark, str(p)).count() == 0
    e = tmp_path / "empty.csv"
    _write(e, "")
    with pytest.raises(ValueError):
        files.scan_csv(spark, str(e))


def test_write_csv_refuses_empty(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_csv(spark.createDataFrame([], "a string"), str(tmp_path / "out"))


def test_jsonl_drops_or_quarantines_bad_lines(spark, tmp_path):
    p = tmp_path / "tx.jsonl"
    _write(p, '{"id": "1", "amount": "$1000.00"}\nnot json\n{"id": "2", "amount": "$5.00"}\n')
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("amount", T.StringType())])
    assert sorted(r.id for r in files.scan_jsonl(spark, str(p), schema).collect()) == ["1", "2"]
    q = files.scan_jsonl(spark, str(p), schema, quarantine=True).collect()
    assert [r[files.CORRUPT] for r in q if r[files.CORRUPT] is not None] == ["not json"]


def test_json_document_gz(spark, tmp_path):
    p = tmp_path / "doc.json.gz"
    with gzip.open(p, "wt") as f:
        json.dump({"a": 1, "b": {"c": "x"}}, f, indent=2)
    r = files.scan_json_doc(spark, str(p)).first()
    assert r.a == 1 and r.b.c == "x"


def test_zip_members(spark, tmp_path):
    p = tmp_path / "fy2024.zip"
    with zipfile.ZipFile(p, "w") as z:
        z.writestr("part1.csv", "id,amount\n1,10\n2,20\n")
        z.writestr("part2.csv", "id,amount\n3,30\n")
    df = files.scan_zip_csv(spark, str(tmp_path))
    assert sorted((r.member, r.id, r.amount) for r in df.collect()) == [
        ("part1.csv", "1", "10"), ("part1.csv", "2", "20"), ("part2.csv", "3", "30")]


def test_listing_and_fingerprint(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    _write(tmp_path / "a.csv", "x\n1\n")
    _write(tmp_path / "sub" / "b.csv", "x\n2\n")
    _write(tmp_path / "c.txt", "no")
    assert files.list_files(spark, str(tmp_path), "*.csv").count() == 1
    assert files.list_files(spark, str(tmp_path), "*.csv", recursive=True).count() == 2
    import hashlib
    fp = files.file_fingerprint(spark, str(tmp_path), "a.csv").first()
    assert fp.sha256 == hashlib.sha256(b"x\n1\n").hexdigest() and fp.length == 4


def test_dictionary_override(spark, tmp_path):
    p = tmp_path / "dict.csv"
    _write(p, 'field_name,type,required,is_key,groups,validation_rules\n'
              'amount,decimal,TRUE,false,"financial,required",\nextra,string,false,false,,\n')
    csv_dict = files.load_dictionary_csv(spark, str(p))
    cfg = spark.createDataFrame([("id", "string", True, True), ("amount", "string", False, False)],
                                "field_name string, type string, required boolean, is_key boolean")
    merged = {r.field_name: r for r in files.merge_dictionary(cfg, csv_dict.drop("groups")).collect()}
    assert merged["amount"].type == "decimal" and merged["amount"].required is True
    assert merged["id"].source == "config" and merged["extra"].source == "csv"
    assert csv_dict.where("field_name = 'amount'").first().groups == ["financial", "required"]


def test_crosswalk_split_and_rules(spark, tmp_path):
    p = tmp_path / "xw.csv"
    header = ",".join(f'"{c}"' for c in files.CROSSWALK_REQUIRED)
    _write(p, header + '\nPIID,"Line one\nline two",PIID,Award Attribute,"A, B\nC",x\n'
                       'bad-name, ,X,Other,"ok,not ok",y\n')
    xw = files.validate_crosswalk(files.scan_crosswalk(spark, str(p)))
    rows = {r.Element: r for r in xw.collect()}
    assert rows["PIID"]["Domain Values"] == ["A", "B", "C"] and rows["PIID"].Definition == "Line one\nline two"
    assert rows["PIID"].problems == []
    assert rows["bad-name"].problems == ["element_format", "definition_empty", "grouping_not_allowed",
                                         "domain_value_format"]


def test_entity_csv_roundtrip(spark):
    df = spark.createDataFrame([("1", "A, B", None)], "a string, b string, c string")
    line = df.select(sinks.entity_csv_line(["a", "b", "c"]).alias("l"))
    back = line.select("l", sinks.entity_from_csv_line("l", ["a", "b", "c"]).alias("e")).first()
    assert back.e.a == "1" and back.e.b == "A, B"


def test_each_file_by_its_own_header(spark, tmp_path):
    _write(tmp_path / "a.csv", "id,name\n1,x\n")
    _write(tmp_path / "b.csv", "name,extra,id\ny,e,2\n")
    rows = {r.id: r for r in files.scan_csv(spark, str(tmp_path / "*.csv")).collect()}
    assert rows["1"].name == "x" and rows["1"].extra is None and rows["2"].name == "y" and rows["2"].extra == "e"
    _write(tmp_path / "c.txt", "id;'na;me'\n3;'a;b'\n")
    r = files.scan_csv(spark, str(tmp_path / "c.txt"), sep=";", quote="'").first()
    assert r["na;me"] == "a;b"


def test_jsonl_schema_from_all_lines(spark, tmp_path):
    _write(tmp_path / "x.jsonl", '{"a": 1}\n{"a": 2, "b": "late"}\n')
    schema = files.jsonl_schema(spark, str(tmp_path / "x.jsonl"))
    assert sorted(r.b or "" for r in files.scan_jsonl(spark, str(tmp_path / "x.jsonl"), schema).collect()) == ["", "late"]


def test_zip_members_by_their_own_header(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "m.zip", "w") as z:
        z.writestr("a.csv", 'id,name\n1,"two\nlines"\n')
        z.writestr("b.csv", "name,id\nz,2\n")
    rows = {r.id: r.name for r in files.scan_zip_csv(spark, str(tmp_path)).collect()}
    assert rows == {"1": "two\nlines", "2": "z"}


def test_crosswalk_selection_and_grouping(spark):
    df = spark.createDataFrame([("PIID", "Award Attribute", "d1"), ("PIID", "Other", "d2"), ("X", "Award Attribute", "d3")],
                               "Element string, Grouping string, Definition string")
    got = files.select_crosswalk(df, {"award_id_piid": {"element": "PIID", "grouping": "Award Attribute"}}).collect()
    assert [(r.field, r.Definition) for r in got] == [("award_id_piid", "d1")]
    got = files.group_crosswalk(df, {"contract": [{"grouping": "Award Attribute", "elements": ["PIID", "X"]}]}).collect()
    assert sorted((r.entity, r.Definition) for r in got) == [("contract", "d1"), ("contract", "d3")]


def test_entity_text_forms_round_trip(spark):
    from decimal import Decimal
    import datetime as dt
    df = spark.createDataFrame(
        [("1", 'say "hi", x', (Decimal("1.50"), dt.date(2024, 1, 2)), [(Decimal("2.25"),)]), ("2", None, None, None)],
        "k string, t string, n struct<m:decimal(10,2),d:date>, l array<struct<m:decimal(10,2)>>")
    line = df.select("k", "t", sinks.entity_csv_line(["k", "t"]).alias("c"))
    back = {r.k: r for r in line.select("k", "c", sinks.entity_from_csv_line("c", ["k", "t"]).alias("r")).collect()}
    assert back["1"].r.t == 'say "hi", x' and '""hi""' in back["1"].c
    j = df.select(sinks.entity_json(df).alias("j"))
    assert '"m":"1.50"' in j.first().j and '"m":"2.25"' in j.first().j
    again = j.select(sinks.entity_from_json("j", df.schema).alias("e")).select("e.*")
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))


def test_csv_headers_read_first_lines_in_tasks(spark, tmp_path):
    folder = tmp_path / "odd names & 100%"
    folder.mkdir()
    _write(folder / "a 1.csv", "x,y\n1,2\n")
    _write(folder / "b+1.csv", "\ufeffy,z\r\n3,4\r\n")
    _write(folder / "empty.csv", "")
    with gzip.open(folder / "c.csv.gz", "wt") as f:
        f.write("x,y\n5,6\n")
    _write(folder / "long.csv", '"x","y"\n' + "".join(f"{i},{i}\n" for i in range(200_000)))
    heads = files.csv_headers(spark, str(folder))
    assert {h: [f.rsplit("/", 1)[1] for f in fs] for h, fs in heads.items()} == {
        ("x", "y"): ["a 1.csv", "c.csv.gz", "long.csv"], ("y", "z"): ["b+1.csv"]}
    rows = files.scan_csv(spark, str(folder))
    assert rows.columns == ["x", "y", "z"] and rows.count() == 200_003
    assert [tuple(r) for r in rows.where("z IS NOT NULL").collect()] == [(None, "3", "4")]
    latin = tmp_path / "latin.csv"
    _write(latin, "na\u00efve,b\n\u00e9,2\n", encoding="latin-1")
    assert files.scan_csv(spark, str(latin), encoding="ISO-8859-1").first().asDict() == {"na\u00efve": "\u00e9", "b": "2"}
    # the session's own scan settings stay
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "1t"


def test_jsonl_schema_kept_beside_the_data(spark, tmp_path, monkeypatch):
    data, kept = tmp_path / "in", str(tmp_path / "schema")
    data.mkdir()
    _write(data / "1.json", '{"a": 1}\n')
    assert files.jsonl_schema(spark, str(data), kept).names == ["a"]
    reader = type(spark.read)
    monkeypatch.setattr(reader, "json", lambda *a, **k: pytest.fail("the input was read again"))
    assert files.jsonl_schema(spark, str(data), kept).names == ["a"]
    monkeypatch.undo()
    _write(data / "2.json", '{"b": {"c": "x"}}\n')  # another file: the schema is made anew
    assert files.jsonl_schema(spark, str(data), kept).names == ["a", "b"]
    assert files.scan_jsonl(spark, str(data), files.jsonl_schema(spark, str(data), kept)).count() == 2


def test_is_key_is_exact_under_colliding_hashes(spark):
    from pyspark.sql import functions as F

    from fedlake.operators import metrics

    def parity(c):
        return c % 2

    distinct = spark.range(1000).select("id", F.lit(1).alias("same"), F.when(F.col("id") > 0, F.col("id")).alias("gap"))
    assert metrics.is_key(distinct, "id")
    assert metrics.is_key(distinct, "id", parity)          # every hash collides, no value repeats
    assert not metrics.is_key(distinct, "same")
    assert not metrics.is_key(distinct, "gap")             # a null
    assert metrics.is_key(distinct.limit(0), "id")
    odd = distinct.select("id").union(spark.createDataFrame([(7,)], "id long"))
    assert not metrics.is_key(odd, "id", parity)           # the repeated value is not under the first hash looked at
    assert not metrics.is_key(odd, "id")
