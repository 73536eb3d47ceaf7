"""CASE-style helpers: decodes, presence flags, FK-presence selection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode(col: Column, mapping, default=None) -> Column:
    """Simple ``CASE col WHEN k THEN v ... [ELSE default] END`` (no ELSE -> NULL)."""
    out = None
    for k, v in (mapping.items() if isinstance(mapping, dict) else mapping):
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def presence_flag(col: Column) -> Column:
    """``CASE WHEN col IS NOT NULL THEN 1 ELSE 0 END``."""
    return F.when(col.isNotNull(), F.lit(1)).otherwise(F.lit(0))


def is_true(col: Column) -> Column:
    """``col IS TRUE``: NULL and false are both not true."""
    return col.eqNullSafe(F.lit(True))


def coalesce_case(*cols: Column) -> Column:
    """``CASE WHEN a IS NOT NULL THEN a ELSE b END`` chains."""
    return F.coalesce(*cols)


def when_present(key: Column, if_present: Column, otherwise: Column) -> Column:
    """Pick by presence of a foreign key, not of the looked-up value."""
    return F.when(key.isNotNull(), if_present).otherwise(otherwise)
