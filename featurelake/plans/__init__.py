"""All registered queries."""

from . import checks, cleaning, models, monitoring, relational, streams, tables  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
