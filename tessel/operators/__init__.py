"""Relational operators: filters, joins, aggregations, windows, sampling, dedup, graph."""
