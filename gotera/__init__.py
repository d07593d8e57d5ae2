"""gotera: utility-consumption anomaly analytics on Spark DataFrames."""

from gotera.session import get_session

__all__ = ["get_session"]
