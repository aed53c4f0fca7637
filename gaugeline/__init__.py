"""Observational time-series analytics as Spark DataFrame operators."""

from gaugeline.schema import SeriesSpec
from gaugeline.session import build_session

__all__ = ["SeriesSpec", "build_session"]
