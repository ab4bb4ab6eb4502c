"""Queries over the test tables: candles derived from events and lineitem, with a DuckDB answer for each."""
