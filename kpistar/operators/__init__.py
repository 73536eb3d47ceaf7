"""Relational building blocks shared by the dimension, fact and report plans."""

from kpistar.operators.joins import anti_orphans, bounded_broadcast, estimated_bytes, lookup  # noqa: F401
from kpistar.operators.windows import emit_once, event_window  # noqa: F401
from kpistar.operators.ordering import pg_asc, pg_order  # noqa: F401
