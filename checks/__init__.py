"""Registered queries, their DuckDB counterparts and the tables both run on."""
