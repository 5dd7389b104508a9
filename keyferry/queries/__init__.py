from . import expressions, file_loads, joins, landed, loads, merges, quality, reshaping, rowsets  # noqa: F401  (registration)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
