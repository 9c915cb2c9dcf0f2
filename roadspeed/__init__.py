"""Road-link speed analytics on Spark: day-partitioned lake, gold table, forecasting data."""

from roadspeed.session import build_session, materialise, scratch_dir

__all__ = ["build_session", "materialise", "scratch_dir"]
