"""Analytics operators for PySpark: plain functions from DataFrame to DataFrame."""

from tallyforge.session import build_session

__all__ = ["build_session"]
