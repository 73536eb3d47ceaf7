"""Column-expression helpers that keep PostgreSQL report semantics on Spark.

All helpers build JVM-side Catalyst expressions (no Python UDFs), so they stay
inside whole-stage code generation.
"""

from kpistar.functions.text import pg_concat, pg_concat_op  # noqa: F401
from kpistar.functions.numeric import base_price, discount_due, int_div, is_integral, pg_int  # noqa: F401
from kpistar.functions.temporal import (  # noqa: F401
    at_report_tz, dmy, interval_days, period_filter, year_ranges)
from kpistar.functions.logic import (  # noqa: F401
    coalesce_case, decode, is_true, presence_flag, when_present)
