"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_segment(column: Column) -> Column:
    """What follows the last '/' or ':'; the whole text if neither occurs."""
    return F.substring_index(F.substring_index(column, "/", -1), ":", -1)


def json_text(column: Column, key: str) -> Column:
    """One top-level member of a JSON object as text."""
    return F.get_json_object(column, f"$.{key}")
