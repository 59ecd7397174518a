"""All queries of the engine proper, by name, and the SQL they are compared with."""

from tessel.plans import choice, code, edits, files, tables, reports  # noqa: F401 - registers its queries
from tessel.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
