"""Joins, aggregations, windows, feature tools, retrieval and graph operators."""
