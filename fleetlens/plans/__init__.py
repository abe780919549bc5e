"""End-to-end plans: family jobs, the query registry and the DuckDB oracle SQL."""
