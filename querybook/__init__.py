"""The registered queries: each operator on the test tables, next to the SQL that an
independent engine runs for the same answer."""

from .book import ORACLE, QUERIES
from . import aggregates, audits, catalog, changes, views  # noqa: F401  (they register)

__all__ = ["ORACLE", "QUERIES"]
