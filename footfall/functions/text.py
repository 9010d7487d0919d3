from __future__ import annotations

from pyspark.sql import Column, functions as F


def split_ids(ids: Column) -> Column:
    """Tokens of a comma-separated id list, duplicates kept, blanks dropped."""
    return F.filter(F.split(ids, ","), lambda token: F.trim(token) != "")
