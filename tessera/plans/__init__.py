"""Registered queries over the fixture tables and their DuckDB oracles."""

from tessera.plans.catalog import entry_query, oracle_sql, queries

__all__ = ["entry_query", "queries", "oracle_sql"]
