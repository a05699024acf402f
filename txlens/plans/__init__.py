"""Named queries over the supplied tables and their DuckDB oracle SQL."""
