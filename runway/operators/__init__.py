"""Reusable DataFrame operators: data quality, aggregates, joins."""
