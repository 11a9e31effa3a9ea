"""Queries over the test tables, each with the SQL that must agree."""

from catalog.registry import IDS, QUERIES, SQL

from catalog import aggregates, cleaning, joins, metrics, scalars, sources, years  # noqa: E402,F401  (fill the registry)

__all__ = ["IDS", "QUERIES", "SQL"]
