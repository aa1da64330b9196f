"""Batch and streaming operators for trip and event data on PySpark DataFrames."""

from meterlane.session import build_session, prepare, release

__all__ = ["build_session", "prepare", "release"]
