"""Scalar rules of the reports: PostgreSQL semantics on Spark."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from kpistar.functions import (decode, discount_due, int_div, interval_days, is_true, period_filter,
                               pg_concat, pg_concat_op, pg_int, presence_flag, when_present, year_ranges)


def _one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).first()["x"]


def test_concat_function_skips_nulls(spark):
    assert _one(spark, pg_concat(F.col("a"), "_", F.col("b")), "a long, b string", (5, None)) == "5_"
    assert _one(spark, pg_concat(F.col("a"), F.col("b")), "a long, b string", (None, None)) == ""


def test_concat_operator_propagates_nulls(spark):
    assert _one(spark, pg_concat_op(F.col("a"), " ", F.col("b")), "a string, b string", ("x", None)) is None
    assert _one(spark, pg_concat_op(F.col("a"), "|", F.col("b")), "a long, b long", (7, 3)) == "7|3"


def test_numeric_to_int_rounds_and_division_truncates(spark):
    assert _one(spark, pg_int(F.col("p")), "p decimal(8,2)", (Decimal("15.50"),)) == 16
    assert _one(spark, pg_int(F.col("p")), "p decimal(8,2)", (Decimal("15.49"),)) == 15
    assert _one(spark, int_div(F.col("a"), 10), "a long", (15,)) == 1
    assert _one(spark, int_div(F.col("a"), 10), "a long", (5,)) == 0


def test_discount_due_matrix(spark):
    rows = [(1000, Decimal("5")), (1000, Decimal("10")), (1000, Decimal("15")), (1000, Decimal("100")),
            (1000, None), (0, Decimal("10")), (None, Decimal("10")), (999, Decimal("25"))]
    df = spark.createDataFrame(rows, "cost long, pct decimal(8,2)")
    got = [r.x for r in df.select(discount_due(F.col("cost"), F.col("pct")).alias("x")).collect()]
    # cost * (pct::int / 10) / 10 with integer divisions; free (0) and unknown cost -> NULL
    assert got == [0, 100, 100, 1000, 1000, None, None, 199]


def test_interval_days_truncate_toward_zero(spark):
    start = dt.datetime(2020, 1, 10, 12, 0)
    cases = [(start - dt.timedelta(hours=-23), 0), (start - dt.timedelta(hours=-25), -1),
             (start, 0), (start - dt.timedelta(hours=23), 0), (start - dt.timedelta(hours=25), 1),
             (start - dt.timedelta(days=-2, hours=-1), -2)]
    df = spark.createDataFrame([(start, b) for b, _ in cases], "s timestamp_ntz, b timestamp_ntz")
    got = [r.x for r in df.select(interval_days(F.col("s"), F.col("b")).alias("x")).collect()]
    assert got == [e for _, e in cases]


def test_year_ranges_and_period_filter(spark):
    assert year_ranges(["2017", "2016"]) == (("2016-01-01", "2017-01-01"), ("2017-01-01", "2018-01-01"))
    df = spark.createDataFrame([(dt.datetime(2015, 12, 31, 23),), (dt.datetime(2016, 1, 1),),
                                (dt.datetime(2017, 5, 31),), (dt.datetime(2017, 6, 1),)], "t timestamp_ntz")
    kept = df.where(period_filter(F.col("t"), (("2016-01-01", "2017-06-01"),))).count()
    assert kept == 2


def test_decode_without_else_is_null_and_flags(spark):
    df = spark.createDataFrame([(6,), (3,), (9,), (None,)], "lvl int")
    got = [r.x for r in df.select(decode(F.col("lvl"), {6: "technolog", 3: "education_director"}).alias("x")).collect()]
    assert got == ["technolog", "education_director", None, None]
    got = [r.x for r in df.select(presence_flag(F.col("lvl")).alias("x")).collect()]
    assert got == [1, 1, 1, 0]


def test_is_true_and_presence_choice(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r.x for r in df.select(is_true(F.col("b")).alias("x")).collect()] == [True, False, False]
    df = spark.createDataFrame([(1, None, "s"), (None, "t", "s")], "k long, a string, b string")
    got = [r.x for r in df.select(when_present(F.col("k"), F.col("a"), F.col("b")).alias("x")).collect()]
    # the key decides, not the looked-up value: a present key with a missing row gives NULL
    assert got == [None, "s"]
