"""Keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Delete keys of the warehouse tables.
USAGE_KEYS = ("date_dim_id", "aws_account_dim_id", "resource", "tag_dim_id")
COST_KEYS = ("date_dim_id", "aws_account_dim_id", "aws_product_dim_id", "tag_dim_id")
TRANSFER_KEYS = ("date_dim_id", "linked_account_id")
COMMITMENT_KEYS = ("date_dim_id",)


def unstaged(target: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not staged. A null in the key matches nothing, so such rows stay."""
    return target.join(stage.select(*keys).distinct(), list(keys), "left_anti").select(*target.columns)


def upsert(target: DataFrame, stage: DataFrame, keys: Sequence[str], *, day: str | None = None) -> DataFrame:
    """Target rows whose key is not staged, plus every staged row.

    Columns match by name. A null in the key matches nothing, so such target
    rows stay; staged duplicates all arrive. The staged keys are made distinct
    before the anti-join (the same shuffle serves both).

    ``day`` names the column of the key that holds a day. Target rows of other
    days than the staged ones match nothing and are not shuffled; the staged
    days, as few as a calendar has, are broadcast. Target and stage should be
    stored, because they are read once more each.
    """
    columns = target.columns
    parts = [stage.select(*columns)]
    if day is not None:
        days = F.broadcast(stage.select(day).distinct())
        parts.append(target.join(days, day, "left_anti").select(*columns))
        target = target.join(days, day, "left_semi").select(*columns)
    kept = unstaged(target, stage, keys)
    for part in parts:
        kept = kept.unionByName(part)
    return kept
