"""Event-lakehouse analytics on Spark: raw, clean and aggregate layers as DataFrame jobs."""

from tidewell.session import build_session, prepare

__all__ = ["build_session", "prepare"]
