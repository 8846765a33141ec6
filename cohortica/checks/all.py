"""All registered queries."""

from cohortica.checks import customers, features, recommend, tables  # noqa: F401
from cohortica.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
