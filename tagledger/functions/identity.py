"""Keys that stay the same over runs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def product_id(product_name: Column, category: Column) -> Column:
    """md5 of the normalised name and the category; a null category is left out."""
    return F.md5(F.concat_ws("||", F.lower(F.trim(product_name)), category))
