"""Workloads, the query registry and its SQL oracle."""

from warbler.plans.oracle import ORACLE_SQL
from warbler.plans.registry import QUERIES
from warbler.plans.workspace import Workspace

__all__ = ["ORACLE_SQL", "QUERIES", "Workspace"]
