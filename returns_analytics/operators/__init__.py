"""Relational steps: windows, joins, aggregates, checks and upserts."""
