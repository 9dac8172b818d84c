"""pitlane: point-in-time match analytics and tabular modelling operators on Spark DataFrames."""

from pitlane.session import get_session

__all__ = ["get_session"]
