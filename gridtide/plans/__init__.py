"""Query plans: test fixtures derived from the driver tables, the end-to-end
chain, the registered queries and their DuckDB oracles."""
