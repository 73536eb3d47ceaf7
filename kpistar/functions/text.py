"""String concatenation with the two PostgreSQL NULL behaviours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _str(c) -> Column:
    if isinstance(c, Column):
        return c.cast("string")
    return F.lit(c)


def pg_concat(*parts) -> Column:
    """PostgreSQL ``concat(a, b, ...)``: NULL arguments are skipped."""
    return F.concat_ws("", *[_str(p) for p in parts])


def pg_concat_op(*parts) -> Column:
    """PostgreSQL ``a || b``: any NULL operand makes the result NULL.

    Plain Python strings are literals; Columns are cast to string.
    """
    return F.concat(*[_str(p) for p in parts])
