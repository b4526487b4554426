"""Tag columns and surrogate keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.schemas import TAG_PREFIX

# The natural columns of the product dimension.
PRODUCT_COLUMNS = (
    "line_item_operation",
    "line_item_product_code",
    "product_product_family",
    "product_region",
    "product_servicecode",
    "product_servicename",
)


def prefixed_columns(df: DataFrame, prefix: str = TAG_PREFIX) -> list[str]:
    """Columns starting with ``prefix``, sorted by name."""
    return sorted(c for c in df.columns if c.lower().startswith(prefix))


def containing_columns(df: DataFrame, text: str) -> list[str]:
    """Columns with ``text`` anywhere in their name, sorted: for exports whose tags have other prefixes."""
    return sorted(c for c in df.columns if text.lower() in c.lower())


def tag_columns(*frames: DataFrame) -> list[str]:
    """Tag columns of all sources together, the list every key must share."""
    return sorted({c for df in frames for c in prefixed_columns(df)})


def clean_text(column: Column) -> Column:
    """Null and empty text both become ''.

    The column occurs once in the expression: projections that clean several
    times over merge without copying what they clean.
    """
    return F.coalesce(column, F.lit(""))


def with_clean_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Clean the named text columns; a column the frame lacks becomes ''."""
    present = {c.lower() for c in df.columns}
    return df.withColumns(
        {c: clean_text(F.col(c)) if c.lower() in present else F.lit("") for c in columns}
    )


def surrogate_key(columns: Iterable[str]) -> Column:
    """SHA-256 (lowercase hex) of the values in column-name order.

    Nulls count as '' so that every place that hashes the same values, fact
    or dimension, arrives at the same key. Adding a column changes all keys.
    """
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(columns)]
    return F.sha2(F.concat_ws("||", *values), 256)
