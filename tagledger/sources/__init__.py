"""Readers: bronze JSON slots, silver Parquet, page tables, number and date spines."""
