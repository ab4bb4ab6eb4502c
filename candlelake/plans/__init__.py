"""Layer jobs, serving tables and read-out queries."""
