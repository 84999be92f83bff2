from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bondscope.config import CORP, MUNI, JsonField
from bondscope.functions import expressions as ex


def values(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_try_float(spark):
    text = ["101.5", " -3 ", ".5", "5.", "1e2", "", "  ", "abc", "NaN", "1d", "Infinity", None, "{}"]
    expected = [101.5, -3.0, 0.5, 5.0, 100.0, 0.0, 0.0, None, None, None, None, None, None]
    assert values(spark, [(t,) for t in text], "t string", ex.try_float(F.col("t"))) == expected


def test_try_decimal(spark):
    text = ["99.125", "99.123455", "-0.000005", "1e2", "", "12345678.5", "x", None]
    expected = [Decimal("99.12500"), Decimal("99.12346"), Decimal("-0.00001"), None, None, None, None, None]
    got = values(spark, [(t,) for t in text], "t string", ex.try_decimal(F.col("t"), "decimal(12,5)"))
    assert got == expected


def test_json_fields_of_corporates(spark):
    rows = [
        ('{"Counts":{"All":{"PVR":7,"BID":"5","OFR":"x"}},"OgBidCmp":"99.12500","OgOfrCmp":99.5}',),
        ('{"Counts":{"All":{"PVR":{"n":1}}},"OgBidCmp":""}',),
        ('{"Counts":"none","OgOfrCmp":"1e2"}',),
        ("{broken",),
        (None,),
    ]
    frame = ex.with_json_fields(spark.createDataFrame(rows, "AdditionalData string"), "AdditionalData", CORP.json_fields)
    got = [tuple(r)[1:] for r in frame.collect()]
    assert got == [
        (7.0, 5.0, None, Decimal("99.12500"), Decimal("99.50000")),
        (None, None, None, None, None),
        (None, None, None, None, None),
        (None, None, None, None, None),
        (None, None, None, None, None),
    ]


def test_json_text_of_munis_keeps_text_and_drops_objects(spark):
    rows = [('{"OgBdCmp":"100.10","OgOfCmp":101.25,"BdOfSprMsg":"wide"}',), ('{"OgBdCmp":{"a":1},"BdOfSprMsg":[1]}',)]
    frame = ex.with_json_fields(spark.createDataFrame(rows, "JsonDetail string"), "JsonDetail", MUNI.json_fields)
    assert [tuple(r)[1:] for r in frame.collect()] == [("100.10", "101.25", "wide"), (None, None, None)]


def test_json_paths_are_case_sensitive(spark):
    frame = spark.createDataFrame([('{"ogbidcmp":"1"}',)], "t string")
    assert ex.with_json_fields(frame, "t", [JsonField("v", "OgBidCmp", "text")]).first().v is None


@pytest.mark.parametrize("kind, on, off", [("boolean", True, False), ("int", 1, 0)])
def test_flags_of_both_types(spark, kind, on, off):
    frame = spark.createDataFrame([(on,), (off,), (None,)], f"f {kind}")
    assert [r.f for r in frame.where(ex.is_set(frame, "f")).collect()] == [on]
    assert {r.f for r in frame.where(ex.not_set(frame, "f")).collect()} == {off, None}


def test_time_predicates(spark):
    moments = ["2024-01-26 15:00:00", "2024-01-26 15:00:00.5", "2024-01-26 14:59:59", "2024-01-27 15:00:00"]
    rows = [(datetime.fromisoformat(m),) for m in moments]
    assert values(spark, rows, "t timestamp_ntz", ex.at_hour(F.col("t"), 15)) == [True, True, False, True]
    assert values(spark, rows, "t timestamp_ntz", ex.on_weekday(F.col("t"))) == [True, True, True, False]


def test_not_blank(spark):
    rows = [("NY",), ("",), ("  ",), (None,)]
    frame = spark.createDataFrame(rows, "s string")
    assert [r.s for r in frame.where(ex.not_blank(F.col("s"))).collect()] == ["NY"]


def test_short_name_keeps_separators_of_missing_parts(spark):
    rows = [("NY", "ABC", 5.125, date(2030, 1, 2)), (None, None, None, None), ("TX", "", 4.0, None)]
    schema = "s string, t string, c double, m date"
    expression = ex.short_name(*(F.col(c) for c in "stcm"))
    assert values(spark, rows, schema, expression) == ["NY ABC 5.13 01/02/2030", "   ", "TX  4.00 "]


def test_resolved_coupon(spark):
    rows = [
        (3.0, 1.0, 100.0, 9.0, 5.0),  # average coupon wins
        (None, 1.0, 100.0, 3.0, 5.0),  # floored
        (None, 1.0, 250.0, 3.0, 5.0),  # floating above the floor
        (None, -2.0, 100.0, None, 5.0),  # negative without floor
        (None, -2.0, 100.0, -3.0, 5.0),  # negative above a negative floor
        (None, 1.0, None, 3.0, 5.0),  # no spread
        (None, None, 100.0, 3.0, 5.0),  # fixed
    ]
    expression = ex.resolved_coupon(*(F.col(c) for c in ("w", "c", "s", "f", "x")))
    got = values(spark, rows, "w double, c double, s double, f double, x double", expression)
    assert got == [3.0, 3.0, 3.5, 0.0, 0.0, None, 5.0]


def test_derived_sector(spark):
    rows = [("BBB", 10, "x"), ("BB", 11, "x"), (None, None, "Energy"), (None, None, None), ("?", None, "x")]
    expression = ex.derived_sector(F.col("r"), F.col("o"), F.col("s"))
    assert values(spark, rows, "r string, o int, s string", expression) == ["IG", "HY", "Energy", "HY", "HY"]


def test_changes(spark):
    rows = [(110.0, 100.0), (110.0, 0.0), (-1.0, 2.0), (None, 2.0), (2.0, None)]
    schema = "n double, b double"
    n, b = F.col("n"), F.col("b")
    assert values(spark, rows, schema, F.round(ex.change(n, b), 6)) == [0.1, None, -1.5, None, None]
    assert values(spark, rows, schema, ex.guarded_change(n, b, "decimal(20,6)")) == [Decimal("0.100000"), *[None] * 4]


def test_decimal_ratio_cuts_the_last_digit(spark):
    rows = [(2, 3), (1, 0), (0, 5), (1, 8)]
    got = values(spark, rows, "p long, w long", ex.decimal_ratio(F.col("p"), F.col("w")))
    assert got == [Decimal("0.6666666666"), None, Decimal("0E-10"), Decimal("0.1250000000")]


def test_decimal_ratio_keeps_the_decimals_of_the_divisor(spark):
    rows = [(Decimal(6), Decimal("3.00004")), (Decimal(1), Decimal(2 * 10**14)), (Decimal(-2), Decimal(3))]
    got = values(spark, rows, "p decimal(20,5), w decimal(20,5)", ex.decimal_ratio(F.col("p"), F.col("w")))
    assert got == [Decimal("1.9999733336"), Decimal("0E-10"), Decimal("-0.6666666666")]


def test_text_that_looks_like_a_container_stays(spark):
    texts = ['{"BdOfSprMsg":"[wide] 2pt"}', '{"BdOfSprMsg":{"a":1}}', '{"BdOfSprMsg":[1]}', '{"BdOfSprMsg":"{x"}', "{"]
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    field = next(f for f in MUNI.json_fields if f.path == "BdOfSprMsg")
    got = dict(ex.with_json_fields(frame, "t", [field]).select("n", field.column).collect())
    assert got == {0: "[wide] 2pt", 1: None, 2: None, 3: "{x", 4: None}


def test_percent_increase(spark):
    rows = [(15.0, 11.0), (5.0, 0.0), (5.0, None), (5.0, -1.0), (1.0, 3.0)]
    got = values(spark, rows, "n double, b double", ex.percent_increase(F.col("n"), F.col("b")))
    assert got == [Decimal("0.3636363636"), Decimal(0), Decimal(0), Decimal(0), Decimal("-0.6666666667")]
