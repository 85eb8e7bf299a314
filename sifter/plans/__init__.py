"""Named query plans bound to the driver tables, with their DuckDB oracle SQL."""
