"""kpistar: training-programme KPI datasets as Spark DataFrame plans.

Every dimension, fact and report is a function from DataFrames to a
DataFrame.  Nothing is collected to the driver; joins, windows and
aggregations are left to Catalyst / AQE.
"""

from kpistar.config import ReportParams  # noqa: F401
from kpistar.session import build_session, ensure_checkpoint_dir  # noqa: F401
