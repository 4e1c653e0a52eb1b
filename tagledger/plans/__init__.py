"""Composed jobs: pages to bronze, bronze to silver, silver to star schema."""
