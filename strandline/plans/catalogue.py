"""All queries of the engine's own operators, by name."""

from __future__ import annotations

from strandline.plans import registry, series_queries, table_queries  # noqa: F401 - the modules fill the registry


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict:
    return dict(registry.SQL)
