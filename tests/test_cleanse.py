"""Edge fixtures for the column rules (traps N1, N7-N13)."""

import datetime as dt
from decimal import Decimal

import pytest

from strata.functions import cleanse as C


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("v")).collect()]


def test_decode_country_blank_null_and_passthrough(spark):
    vals = ["DE", "US", "USA", " USA ", "us", "  ", "", None, " Canada "]
    got = _one(spark, [(v,) for v in vals], "c string",
               C.decode("c", C.COUNTRY_CODES, normalize=False, passthrough=True, blank_to=C.UNKNOWN))
    assert got == ["Germany", "United States", "United States", "United States", "us", "n/a", "n/a", "n/a",
                   "Canada"]


def test_decode_codes_normalised(spark):
    vals = ["s", " S ", "m", "M", "x", "", None]
    got = _one(spark, [(v,) for v in vals], "c string", C.decode("c", C.MARITAL_CODES))
    assert got == ["Single", "Single", "Married", "Married", "n/a", "n/a", "n/a"]
    got = _one(spark, [(v,) for v in ["female", " F", "MALE", "m ", "", None, "x"]], "c string",
               C.decode("c", C.GENDER_SPELLINGS))
    assert got == ["Female", "Female", "Male", "Male", "n/a", "n/a", "n/a"]


def test_int_to_date(spark):
    vals = [0, None, 32154, 20240229, 20101332, -1234567, 19991231]
    got = _one(spark, [(v,) for v in vals], "v bigint", C.int_to_date("v"))
    assert got == [None, None, None, dt.date(2024, 2, 29), None, None, dt.date(1999, 12, 31)]


def test_int_to_date_strict_raises(spark):
    df = spark.createDataFrame([(20101332,)], "v bigint").select(C.int_to_date("v", strict=True))
    with pytest.raises(Exception):
        df.collect()


def test_future_to_null(spark):
    vals = [dt.date(2025, 6, 29), dt.date(2025, 6, 30), dt.date(2025, 7, 1), None]
    got = _one(spark, [(v,) for v in vals], "d date", C.future_to_null("d", "2025-06-30"))
    assert got == [dt.date(2025, 6, 29), dt.date(2025, 6, 30), None, None]


def test_repair_amount_and_price(spark):
    rows = [(Decimal("10.00"), 2, Decimal("5.00")),    # consistent
            (None, 2, Decimal("5.00")),                 # missing sales
            (Decimal("0.00"), 2, Decimal("-5.00")),     # zero sales, negative price
            (Decimal("9.00"), 2, Decimal("5.00")),      # inconsistent
            (Decimal("7.00"), 2, None),                 # price missing: sales kept (3VL)
            (None, 2, None),                            # both missing
            (Decimal("7.00"), 0, None),                 # qty 0: price stays NULL
            (Decimal("1.00"), 3, Decimal("0.00"))]      # fractional repaired price
    df = spark.createDataFrame(rows, "s decimal(18,2), q bigint, p decimal(18,2)")
    out = df.select(C.repair_amount("s", "q", "p").alias("s2"), C.repair_price("s", "q", "p").alias("p2")).collect()
    assert [r.s2 for r in out] == [Decimal("10.00"), Decimal("10.00"), Decimal("10.00"), Decimal("10.00"),
                                  Decimal("7.00"), None, Decimal("7.00"), Decimal("0.00")]
    assert [r.p2 for r in out] == [Decimal("5.000000"), Decimal("5.000000"), Decimal("0.000000"),
                                  Decimal("5.000000"), Decimal("3.500000"), Decimal("0.000000"), None,
                                  Decimal("0.333333")]


def test_prefix_chars_keys(spark):
    got = _one(spark, [("NASAW1",), ("nasAW2",), ("AW3",), (None,)], "c string", C.strip_prefix("c"))
    assert got == ["AW1", "nasAW2", "AW3", None]
    got = _one(spark, [("AW-00-1",), ("AW1",)], "c string", C.remove_chars("c", "-"))
    assert got == ["AW001", "AW1"]
    df = spark.createDataFrame([("CO-RF-FR-R92B-58",), ("AB-C",)], "k string")
    out = df.select(C.key_category("k"), C.key_number("k")).collect()
    assert [tuple(r) for r in out] == [("CO_RF", "FR-R92B-58"), ("AB_C", None)]


def test_full_name_and_master_source(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B"), ("A", None)], "f string, l string")
    assert [r[0] for r in df.select(C.full_name("f", "l")).collect()] == ["A B", " B", "A "]
    df = spark.createDataFrame([("Male", "Female"), ("n/a", "Female"), ("n/a", None), (None, "Male")],
                               "crm string, erp string")
    got = [r[0] for r in df.select(C.coalesce_sources("crm", "erp")).collect()]
    assert got == ["Male", "Female", "n/a", "Male"]
