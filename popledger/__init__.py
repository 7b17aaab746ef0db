"""popledger: rolling-window population reports on health-care claims, on PySpark DataFrames."""

from popledger.session import get_session
from popledger.settings import ReportSettings

__all__ = ["ReportSettings", "get_session"]
