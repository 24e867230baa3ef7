"""Relational operators: ordered history, keys, joins and data quality."""
