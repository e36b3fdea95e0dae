"""Named query plans (the catalog) and their DuckDB oracle SQL."""
