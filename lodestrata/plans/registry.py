"""All queries by name, and the DuckDB twins of those that SQL can express."""

from __future__ import annotations

from . import artifacts, catalog

QUERIES = catalog.QUERIES | artifacts.QUERIES
ORACLE_SQL = catalog.ORACLE_SQL | artifacts.TWINS
