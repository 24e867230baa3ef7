"""Composite plans: extracts, staging, dimensions, facts, analytics and the warehouse build."""
