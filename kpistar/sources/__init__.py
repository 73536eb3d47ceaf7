from kpistar.sources.raw import RawTables  # noqa: F401
from kpistar.sources.domain import Domain  # noqa: F401
