"""Event analytics on Spark: one set of operators for batch tables and Structured Streaming."""

from millrace.session import build_session, prepare

__all__ = ["build_session", "prepare"]
