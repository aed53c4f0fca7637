"""The same queries as SQL texts for an independent engine, used to check results."""

from oracles.sql import ORACLES

__all__ = ["ORACLES"]
