"""Writers: bronze JSON, silver slots, catalog tables and their layouts."""
