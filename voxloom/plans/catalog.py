"""All queries of the library and their SQL, by name."""

from __future__ import annotations

from . import file_queries, lookup_queries, signal_queries, text_queries, timeline_queries

_PARTS = (text_queries, timeline_queries, lookup_queries, signal_queries, file_queries)
QUERIES = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
SQL = {name: sql for part in _PARTS for name, sql in part.SQL.items()}
