"""All queries of the core, and their SQL."""

from __future__ import annotations

from folioframe.plans import document_queries, nested_queries, table_queries

_MODULES = (nested_queries, document_queries, table_queries)
QUERIES = {n: q for m in _MODULES for n, q in m.QUERIES.items()}
SQL = {n: q for m in _MODULES for n, q in m.SQL.items()}
