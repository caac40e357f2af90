"""The registered queries: each operator on the given tables, with its SQL twin."""

from workload import basic, kept, warehouse  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
