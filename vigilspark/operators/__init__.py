"""Relational building blocks: newest row, joins inside a report, tallies, quality rules."""
