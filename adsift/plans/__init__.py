"""Registered queries (``queries``) and their DuckDB oracle SQL (``oracle_sql``)."""
