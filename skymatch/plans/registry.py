"""All sky catalog queries and the SQL that says the same."""

from __future__ import annotations

from . import catalog_queries, filter_queries, match_queries

QUERIES: dict = match_queries.QUERIES | filter_queries.QUERIES | catalog_queries.QUERIES
ORACLES: dict = match_queries.ORACLES | filter_queries.ORACLES | catalog_queries.ORACLES
