"""Every query of the library and its DuckDB equivalent, by name."""

from __future__ import annotations

from pairquarry.plans import evaluation_queries, flow_queries, record_queries, status_queries, text_queries

QUERIES: dict = {**text_queries.QUERIES, **record_queries.QUERIES, **status_queries.QUERIES, **evaluation_queries.QUERIES, **flow_queries.QUERIES}
ORACLE_SQL: dict = {**text_queries.ORACLE_SQL, **record_queries.ORACLE_SQL, **status_queries.ORACLE_SQL, **evaluation_queries.ORACLE_SQL, **flow_queries.ORACLE_SQL}
