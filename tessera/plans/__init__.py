"""Registered queries: one Spark plan and, where SQL can say it, one DuckDB
oracle per operator of the inventory.  Importing this package fills the
registry."""

from tessera.plans.registry import ORACLES, QUERIES
from tessera.plans import relational, vectors, regression, classification  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
