"""Readers, writers and named tables."""
