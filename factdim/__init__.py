"""Data-modelling and analytics operators for Spark DataFrames and streams."""

from .session import build_session, configure, scratch_dir

__all__ = ["build_session", "configure", "scratch_dir"]
