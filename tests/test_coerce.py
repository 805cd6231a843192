"""Column coercions: expectations of the source system's literal unit cases."""
import datetime as dt

from pyspark.sql import functions as F

from ticklake.functions import coerce as C


def one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def test_epoch_to_date(spark):
    assert one(spark, C.epoch_to_date, None) is None
    assert one(spark, C.epoch_to_date, "not-a-number") is None
    assert one(spark, C.epoch_to_date, "0") is None
    assert one(spark, C.epoch_to_date, "-1") is None
    assert one(spark, C.epoch_to_date, "1577836800") == dt.date(2020, 1, 1)


def test_opt_int_and_numeric(spark):
    assert one(spark, C.opt_int, "1.9") == 1
    assert one(spark, C.opt_int, "bad") is None
    assert one(spark, C.opt_int, "NaN") is None
    assert one(spark, C.extract_numeric, "1000.0") == 1000
    assert one(spark, C.extract_numeric, "6.13") == 6
    assert one(spark, C.extract_numeric, "-6.9") == -6
    assert one(spark, C.extract_numeric, "n/a") is None


def test_text_date_decimal(spark):
    assert one(spark, C.clean_text, "  x  ") == "x"
    assert one(spark, C.clean_text, "   ") is None
    assert one(spark, C.to_date10, "2024-01-15T10:00:00") == dt.date(2024, 1, 15)
    assert one(spark, C.to_date10, "15/01/2024") is None
    assert float(one(spark, C.to_dec, " 12.5 ")) == 12.5
    assert one(spark, C.to_dec, "abc") is None
    assert one(spark, C.to_int, "7.9") == 7


def test_form_type(spark):
    assert one(spark, C.form_type, "Form 4") == "4"
    assert one(spark, C.form_type, "Form 4/A") == "4/A"
    df = spark.createDataFrame([("Form 4/A",), ("4",)], "v string")
    got = [r[0] for r in df.select(C.is_amendment(C.form_type("v"))).collect()]
    assert got == [True, False]


def test_fiscal_period(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 15), True), (dt.date(2024, 2, 15), False),
                                (dt.date(2024, 11, 15), False)], "d date, a boolean")
    got = [r[0] for r in df.select(C.fiscal_period_end("d", "a")).collect()]
    assert got == [dt.date(2024, 12, 31), dt.date(2024, 3, 31), dt.date(2024, 12, 31)]
    q = [r[0] for r in df.select(C.fiscal_quarter("d", "a")).collect()]
    assert q == [None, 1, 4]


def test_first_of(spark):
    df = spark.createDataFrame([(None, "b"), ("a", "c")], "x string, y string")
    got = [r[0] for r in df.select(C.first_of(df, "missing", "x", "y")).collect()]
    assert got == ["b", "a"]
