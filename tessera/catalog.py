"""All queries of the library, with the SQL that gives the same rows."""

from __future__ import annotations

from .plans import contracts, diagnosis, direct, guards, market, methods, publish, research, runs, streams, warehouse, wide  # noqa: F401  the others add their queries to those of market


def queries() -> dict:
    return dict(market.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(market.SQL)


SQL_NAMES = tuple(market.SQL)
