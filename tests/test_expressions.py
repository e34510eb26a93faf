"""Guards and formats (FIXTURES 2.2), one column expression at a time."""
from decimal import Decimal

import datetime as dt
import pytest
from pyspark.sql import functions as F

from parcelspark import constants as K
from parcelspark.functions import casts as C
from parcelspark.functions import labels as L
from parcelspark.functions import text as T
from parcelspark.functions.json import json_unwrap, unwrap_text


def one(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_rent_guard(spark):
    got = one(spark, ["-5", "1e3", "1,000", "5.", "10000000", "10000000.01", None], C.rent_amount)
    assert got == [0, 0, 0, 5, 10000000, 0, 0]


def test_units_guard(spark):
    assert one(spark, ["abc", "0", "1000", "1001", "99999999999"], C.units_in_range) == [1, 1, 1000, 1, 1]


def test_geo_each_coordinate_falls_back(spark):
    from parcelspark.operators.unified import geo_columns
    df = spark.createDataFrame([
        ('{"coordinates":[-13.2,14.2,0]}', '{"coordinates":[-16.5,13.45,0]}'),
        ('{"coordinates":[-18,14.2,0]}', '{"coordinates":[-18,14.0,0]}'),
        ('{"coordinates":[-17.0,13.0,0]}', None),
        ('{"coordinates":[-16.1,13.9,0]}', None),
    ], "b string, c string")
    lat, lon = geo_columns(F.col("b"), F.col("c"))
    got = [(r[0], r[1]) for r in df.select(lat, lon).collect()]
    assert got[0] == (Decimal("13.45"), Decimal("-16.5"))
    assert got[1] == (None, None)
    assert got[2] == (Decimal("13.0"), Decimal("-17.0"))
    assert got[3] == (Decimal("13.9"), Decimal("-16.1"))


def test_strict_and_prefix_dates(spark):
    assert one(spark, ["2024-02-30", "2024-1-5", "2024-05-01T10:00:00Z", "2024-05-01"], C.strict_date) == \
        [None, None, None, dt.date(2024, 5, 1)]
    assert one(spark, ["2024-05-01T10:00:00Z"], C.prefix_date) == [dt.date(2024, 5, 1)]


def test_dob_and_age(spark):
    as_of = dt.date(2024, 6, 30)
    assert one(spark, ["1899-12-31", "2030-01-01"], lambda c: C.dob_valid(c, as_of)) == [None, None]
    assert one(spark, ["1899-12-31", "2030-01-01"], lambda c: C.age_from_text(c, as_of)) == [124, None]
    df = spark.createDataFrame([("2000-02-29",)], "d string").select(F.col("d").cast("date").alias("d"))
    r = df.select(C.age_years(F.col("d"), dt.date(2023, 2, 28)), C.age_years(F.col("d"), dt.date(2023, 3, 1))).first()
    assert (r[0], r[1]) == (22, 23)


def test_tin_mobile_email(spark):
    assert one(spark, ["1234567890", " 12 ", "", None], lambda c: T.clean_by_pattern(c, K.TIN_RE)) == \
        ["1234567890", "12", None, None]
    assert one(spark, ["+2201234567", "2201234567", "12345678", " x "], lambda c: T.clean_by_pattern(c, K.MOBILE_RE)) \
        == ["+2201234567", "2201234567", "12345678", "x"]
    email = lambda c: F.when(T.matches(c, K.EMAIL_RE), F.lower(F.trim(c)))
    assert one(spark, ["A.B@X.org", "a+b@x.org", "a@b.c\n"], email) == ["a.b@x.org", None, None]


def test_pg_initcap(spark):
    assert one(spark, ["car_park", "rent_lease", "jane doe-smith", "", None, "ABC def"], T.pg_initcap) == \
        ["Car_Park", "Rent_Lease", "Jane Doe-Smith", "", None, "Abc Def"]


def test_labels_and_defaults(spark):
    assert one(spark, [None, "meeting_scheduled", "call_back"],
               lambda c: L.label(c, K.FOLLOW_UP_LABELS, fallback="New")) == ["New", "Meeting Scheduled", "Call_Back"]
    assert one(spark, [None, "hasIssues"], lambda c: L.label(c, K.REVIEW_STATE_LABELS, fallback="Pending")) == \
        ["Pending", "Has Issues"]
    assert one(spark, [" USD ", "£", "gmd", "cfa", None], L.norm_currency) == ["usd", "pounds", "dalasi", "dalasi", "dalasi"]


@pytest.mark.parametrize("v,txt", [("0", ".00"), ("0.5", ".50"), ("0.125", ".13"), ("1234567.895", "1,234,567.90"),
                                   ("1000000000", "###,###,###.##"), ("10714.5", "10,714.50")])
def test_money_text(spark, v, txt):
    df = spark.createDataFrame([(v,)], "x string").select(F.col("x").cast("decimal(38,8)").alias("x"))
    assert df.select(T.money_text(F.col("x"))).first()[0] == txt


def test_json_reparse_both_forms(spark):
    df = spark.createDataFrame([('{"a":"1"}',), ('"{\\"a\\":\\"1\\"}"',), ("",), (None,), ("null",)], "x string")
    a1 = [r[0] for r in df.select(F.get_json_object(json_unwrap(F.col("x")), "$.a")).collect()]
    a2 = [r[0] for r in df.select(F.from_json(unwrap_text(F.col("x")), "a string")["a"]).collect()]
    assert a1 == a2 == ["1", "1", None, None, None]
