"""Scalar cleaning functions: the Python-isms and trap inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fedlake.functions import codes, dates, numbers, strings


def one(spark, col, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(col.alias("y")).first().y


def test_title_case_python_style(spark):
    assert one(spark, strings.str_title(F.col("x")), "o'neil mc-donald") == "O'Neil Mc-Donald"
    assert one(spark, strings.str_title(F.col("x")), "1st place") == "1St Place"


def test_pad_never_truncates(spark):
    assert one(spark, strings.str_pad(F.col("x"), 3, "0"), "15") == "015"
    assert one(spark, strings.str_pad(F.col("x"), 3, "0"), "12345") == "12345"


def test_trim_all_whitespace(spark):
    assert one(spark, strings.str_trim(F.col("x")), "\t hello world \n") == "hello world"


@pytest.mark.parametrize("text,expected", [("$1,234.50", "1234.50"), ("-5.00", "-5.00"), ("$ 10.00", "10.00"),
                                           ("abc", None), ("", None), (None, None)])
def test_money_parse(spark, text, expected):
    got = one(spark, numbers.money_parse(F.col("x")), text)
    assert (str(got) if got is not None else None) == expected


def test_money_valid_accepts_grouping_quirk(spark):
    assert one(spark, numbers.money_valid(F.col("x")), "1234,567") is True
    assert one(spark, numbers.money_valid(F.col("x")), "12.5") is False


@pytest.mark.parametrize("text,expected", [("2029-09-30 00:00:00", dt.date(2029, 9, 30)), ("09/30/2024", dt.date(2024, 9, 30)),
                                           ("20240930", dt.date(2024, 9, 30)), ("2024-09-30", dt.date(2024, 9, 30)),
                                           ("9/3/2024", dt.date(2024, 9, 3)), ("x", None)])
def test_date_parse_multi(spark, text, expected):
    got = one(spark, dates.date_parse_multi(F.col("x"), ("%m/%d/%Y", "%Y%m%d", "%Y-%m-%d")), text)
    assert got == expected


def test_fiscal_year(spark):
    assert one(spark, dates.fiscal_year(F.col("x")), dt.date(2024, 9, 30), "date") == 2024
    assert one(spark, dates.fiscal_year(F.col("x")), dt.date(2024, 10, 1), "date") == 2025
    assert one(spark, dates.fiscal_year(F.col("x"), 4), dt.date(2024, 4, 1), "date") == 2025


def test_strptime_translation():
    assert dates.strptime_to_java("%m/%d/%Y") == "M/d/yyyy"
    assert dates.strptime_to_java("%Y%m%d") == "yyyyMMdd"
    assert dates.strptime_to_java("%d.%m.%Y", for_output=True) == "dd.MM.yyyy"


def test_booleans(spark):
    for t in ["true", "True", "1", "yes", "Y", "t"]:
        assert one(spark, codes.bool_parse(F.col("x")), t) is True
    for t in ["false", "0", "no", "N", "f"]:
        assert one(spark, codes.bool_parse(F.col("x")), t) is False
    assert one(spark, codes.bool_parse(F.col("x")), "maybe") is None
    assert one(spark, codes.bool_normalize(F.col("x")), " yes, without exception ") == "true"


def test_zip_modes(spark):
    assert one(spark, strings.norm_zip(F.col("x")), "221024200") == "22102-4200"
    assert one(spark, strings.norm_zip(F.col("x")), "2108") == "02108"
    assert one(spark, strings.norm_zip(F.col("x"), "zip5"), "22102-4200") == "22102"


def test_round_half_even_on_decimal(spark):
    assert one(spark, numbers.num_round_clamp(F.col("x"), 2), "2.675") == 2.68
    assert one(spark, numbers.num_round_clamp(F.col("x"), 2), "2.665") == 2.66
    assert one(spark, numbers.num_round_clamp(F.col("x"), 0, 0, 10), "12.4") == 10.0


def test_integer_truncates_toward_zero(spark):
    assert one(spark, numbers.num_int(F.col("x")), "-789.9") == -789
    assert one(spark, numbers.num_int(F.col("x")), "45.67") == 45


def test_enum_and_codes(spark):
    assert one(spark, codes.enum_member(F.col("x"), ["Active", "inactive"]), "ACTIVE") == "ACTIVE"
    assert one(spark, codes.code_decode(F.col("x"), "contract_type"), " b ") == "PURCHASE ORDER"
    assert one(spark, strings.map_values(F.col("x"), {"US": "USA"}), "CA") == "CA"


def test_raise_policy(spark):
    with pytest.raises(Exception):
        one(spark, strings.str_match(F.col("x"), "[0-9]+", on_error="raise"), "abc")


def test_error_policies_keep_and_flag(spark):
    from fedlake.functions.numbers import num_round_clamp
    df = spark.createDataFrame([("1.5",), ("abc",)], "s string")
    kept = [r.v for r in df.select(num_round_clamp("s", on_error="keep").alias("v")).collect()]
    assert kept == ["1.5", "abc"]
    flagged = [r.v for r in df.select(num_round_clamp("s", on_error="flag").alias("v")).collect()]
    assert flagged[0].value == 1.5 and flagged[0].error is None and flagged[1].value is None and flagged[1].error
