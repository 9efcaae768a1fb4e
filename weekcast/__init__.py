"""Weekly series forecasting on Spark: panels in, forecasts and alerts out."""

from .plans import weekly_run
from .schema import FEATURES

__all__ = ["FEATURES", "weekly_run"]
