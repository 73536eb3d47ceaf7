"""Event-grain window helpers for the report sheets.

The reports mark "the first row of an event" with ``row_number() = 1`` and
put event-level values only on that row, so a spreadsheet SUM over the sheet
counts each event once.  PostgreSQL leaves that row arbitrary; here every
window gets a total order over the columns that vary inside an event, so the
row carrying the values is deterministic.  All windows of a report share the
event partitioning, which Spark satisfies with a single exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from kpistar.operators.ordering import pg_asc


def event_window(partition, order=()):
    w = Window.partitionBy(*partition)
    if order:
        w = w.orderBy(*[pg_asc(c) if isinstance(c, str) else c for c in order])
    return w


def emit_once(first, value: Column) -> Column:
    """``CASE WHEN <row is the group's first> THEN value END``; ``first`` is a boolean
    Column or the name of a boolean column."""
    return F.when(F.col(first) if isinstance(first, str) else first, value)
