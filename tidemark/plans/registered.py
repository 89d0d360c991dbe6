"""All registered queries of the library and their oracles."""

from __future__ import annotations

from tidemark.plans import driver_queries, ingest_queries

QUERIES = {**driver_queries.QUERIES, **ingest_queries.QUERIES}
ORACLE_SQL = {**driver_queries.ORACLE_SQL, **ingest_queries.ORACLE_SQL}
