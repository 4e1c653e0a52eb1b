"""Queries over the test tables and their equivalents in plain SQL."""
