"""Integer arithmetic as PostgreSQL evaluates it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pg_int(c: Column) -> Column:
    """``numeric::int`` rounds half away from zero (a Spark cast truncates)."""
    return F.round(c).cast("int")


def int_div(a: Column, b) -> Column:
    """Integer division truncating toward zero (SQL ``div``)."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def is_integral(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def discount_due(cost: Column, percent: Column, integral: bool = True) -> Column:
    """Amount a participant must pay: ``cost * (pct::int / 10) / 10``.

    Free seminars (cost 0) and unknown cost give NULL; without a discount the
    full cost is due.  The percentage is rounded to an integer and its division
    is an integer one, so 15 % becomes 10 % and 5 % becomes 0.  The division of the
    product truncates for an ``integral`` cost only; a numeric cost keeps its
    fraction.
    """
    product = cost * int_div(pg_int(percent), 10)
    discounted = int_div(product, 10) if integral else product / 10
    return F.when(cost != 0, F.when(percent.isNotNull(), discounted).otherwise(cost * 1))


def base_price(coefficient: Column, price: Column) -> Column:
    """Studio coefficient times base price, or the base price alone."""
    return F.when(coefficient.isNotNull(), coefficient * price).otherwise(price)
