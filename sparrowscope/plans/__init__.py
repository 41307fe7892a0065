"""Whole jobs, bindings to the test tables, queries and their SQL."""
