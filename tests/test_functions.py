"""Text, key and date expressions on small inputs, with the results that feeds need."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F, types as T

from feedloom.functions.dates import file_suffix, first_date, header_timestamp, parse_schedule
from feedloom.functions.json import schema_from_prototype
from feedloom.functions.keys import content_hash, row_key
from feedloom.functions.text import (
    canonical_text, cleanse_record, collapse_blanks, delimiter_safe, implied_decimal, implied_decimal_value, normalize_name, picture_decimals, picture_scale, safe_name, snake_case,
)


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", T._parse_datatype_string(kind))]))
    return df.select(expression(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "text,scale,want",
    [
        ("0012345", 2, "123.45"), ("5", 2, "0.05"), ("50", 2, "0.50"), ("000", 2, "0.00"), ("007", 0, "7"), ("0", 0, "0"), ("12a", 2, "12a"),
        ("", 2, ""), ("-12", 2, "-12"), ("12", None, "12"), (None, 2, None), ("9" * 45, 2, "9" * 43 + ".99"), ("123456789", 9, "0.123456789"),
    ],
)
def test_implied_decimal(spark, text, scale, want):
    assert one(spark, text, lambda c: implied_decimal(c, scale)) == want


def test_implied_decimal_value(spark):
    assert str(one(spark, "0012345", lambda c: implied_decimal_value(c, 2))) == "123.45"
    assert one(spark, "x", lambda c: implied_decimal_value(c, 2)) is None


@pytest.mark.parametrize("pic,want", [("9(5)V99", 2), ("9(7)V9(4)", 4), ("X(10)", 0), ("S9(5)", 0), ("9(5) v 999", 3), ("9V9X", 0), ("9(3)V", 0), ("9v9 ( 3 )", 3), ("V9(2)9", 3), ("9V9(", 0), ("9V(3)", 0), ("V", 0), ("", 0), ("9V99V9", 1), ("9(5)V99-", 2)])
def test_picture_scale(spark, pic, want):
    assert one(spark, pic, picture_scale) == want
    assert picture_decimals(pic) == want


def test_blanks_and_delimiters(spark):
    assert one(spark, "  a   b c  ", collapse_blanks) == "a b c"
    assert one(spark, "a|b\r\nc", delimiter_safe) == "a:b  c"
    assert one(spark, "", delimiter_safe) is None
    assert one(spark, 'a~|~b\r\n"c"|d\0e', cleanse_record) == "a|b 'c':de"


def test_names(spark):
    assert normalize_name(" First  Name (x)") == "First_Name_x_"
    assert normalize_name('[A].["B"]', lower=True) == "a_b"
    assert safe_name("Order") == "Order1" and safe_name("orders") == "orders"
    assert [one(spark, n, snake_case) for n in ("orderKey", "12bFee", "a#b")] == ["ORDER_KEY", "_12B_FEE", "A_B"]


def test_name_clash_is_refused(spark):
    from feedloom.operators.columns import normalize_columns

    with pytest.raises(ValueError, match="share a name"):
        normalize_columns(spark.createDataFrame([(1, 2)], ["a b", "A_B"]))


@pytest.mark.parametrize("value,want", [(1e7, "10000000"), (0.0, "0"), (1.5, "1.5"), (-0.25, "-0.25"), (1e25, "1.0E25"), (None, None)])
def test_canonical_text_of_doubles(spark, value, want):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(canonical_text(df, "v").alias("r")).first().r == want


def test_keys(spark):
    df = spark.createDataFrame([("a", None, 1)], "x string, y string, n int")
    got = df.select(row_key(df, ["x", "y"], "s").alias("h"), row_key(df, None, "s", hashed=False).alias("all")).first()
    assert got.h == hashlib.sha256(b"a__s").hexdigest()
    assert got.all == hashlib.sha256(b"a__1_s").hexdigest()


def test_content_hash_keeps_column_borders(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c")], "x string, y string")
    assert df.select(content_hash(df, ["x", "y"])).distinct().count() == 2
    assert df.select(content_hash(df, ["x", "y"], sep="")).distinct().count() == 1


def test_dates(spark):
    at = dt.datetime(2024, 1, 31, 10, 20, 30)
    wanted = {"yyyymmdd": "20240131", "yyyy-mm-dd": "2024-01-31", "yyyymm": "202401", "YYYY-MM": "2024-01", "yyyymmddhhmmss": "20240131102030", "yyyy-mm-dd-hhmmss": "2024-01-31-102030", "other": "", None: ""}
    assert {t: file_suffix(t, at) for t in wanted} == wanted
    assert one(spark, "013199", lambda c: header_timestamp(c, "MMDDYY")) == dt.datetime(1999, 1, 31)
    assert one(spark, "01312024", lambda c: header_timestamp(c, "MMDDYY")) == dt.datetime(2024, 1, 31)
    assert one(spark, "240131", lambda c: header_timestamp(c, "YYMMDD")) == dt.datetime(2024, 1, 31)
    assert one(spark, "13/45/2024", lambda c: first_date(c, ["MM/dd/yyyy", "yyyyMMdd"])) is None


def test_schedule_keeps_every_day():
    assert parse_schedule("BD=[5,6],CD=[7]") == {"BD": [5, 6], "CD": [7]}
    assert parse_schedule(None) == {}


def test_schema_from_prototype():
    got = schema_from_prototype({"a": None, "b": {"c": None}, "d": [{"e": None}]})
    assert got.simpleString() == "struct<a:string,b:struct<c:string>,d:array<struct<e:string>>>"
