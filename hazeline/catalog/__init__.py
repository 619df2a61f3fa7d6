"""All registered queries with their SQL twins."""

from hazeline.catalog import models, monitoring, readings, series, streams  # noqa: F401
from hazeline.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
