"""Jobs composed from the operators, the registered queries and their DuckDB oracles."""
