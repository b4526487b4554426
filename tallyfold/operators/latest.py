"""Latest row per resource and the resource-to-tags bridge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.calendar import calendar_columns
from tallyfold.functions.keys import surrogate_key, with_clean_columns
from tallyfold.functions.text import last_segment


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key under ``order``, which must decide every tie.

    ``row_number() = 1`` lets each map task keep one row per key before the
    shuffle (WindowGroupLimit), so a key holding a third of all rows sends one
    row per task, not its rows.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


RESOURCE = "line_item_resource_id"


def _newest_first(columns: Sequence[str]) -> list[Column]:
    ties = sorted((c for c in columns if c.startswith("_tie_")), key=lambda c: int(c.removeprefix("_tie_")))
    return [F.col("line_item_usage_start_date").desc(), *[F.col(c) for c in ties]]


def newest_lines(lines: DataFrame, tag_cols: Sequence[str], *, tie_break: Sequence[Column]) -> DataFrame:
    """Each resource's newest billing line, with what the bridge and a later merge need of it.

    Lines without a resource id form a group like any other.
    """
    narrow = lines.select(
        RESOURCE,
        "line_item_usage_start_date",
        "line_item_usage_account_id",
        *tag_cols,
        *[F.col(c).alias(f"_billed_{c}") for c in ("year", "month")],
        *[column.alias(f"_tie_{i}") for i, column in enumerate(tie_break)],
    )
    return latest_per(narrow, [RESOURCE], _newest_first(narrow.columns))


def merge_newest(stored: DataFrame, newer: DataFrame) -> DataFrame:
    """Newest lines of two sets of lines from the newest lines of each.

    The greatest (start, tie-break) of a union is the greatest of the parts'
    greatest, so nothing but one row per resource is read again. A tag column
    that only one of them has is null in the other.
    """
    both = stored.unionByName(newer, allowMissingColumns=True)
    return latest_per(both, [RESOURCE], _newest_first(both.columns))


def bridge_rows(newest: DataFrame, tag_cols: Sequence[str], *, period: tuple[int, int] | None = None) -> DataFrame:
    """Resource -> tag key, from newest lines.

    ``period`` keeps the resources whose newest line *of all history* was
    billed in that month; it applies after ranking and cannot move before it.
    """
    if period is not None:
        year, month = period
        newest = newest.where((F.col("_billed_year") == int(year)) & (F.col("_billed_month") == int(month)))
    dated = newest.withColumns(calendar_columns(F.col("line_item_usage_start_date")))
    filled = with_clean_columns(dated, [RESOURCE, "line_item_usage_account_id", *tag_cols])
    return filled.select(
        last_segment(F.col(RESOURCE)).alias(RESOURCE),
        "line_item_usage_start_date",
        "line_item_usage_account_id",
        surrogate_key(tag_cols).alias("tag_dim_id"),
        "year",
        "month",
        "day",
    )


def latest_tags(
    lines: DataFrame,
    tag_cols: Sequence[str],
    *,
    tie_break: Sequence[Column],
    period: tuple[int, int] | None = None,
) -> DataFrame:
    """Resource -> tag key of its newest billing line, by ranking all lines."""
    return bridge_rows(newest_lines(lines, tag_cols, tie_break=tie_break), tag_cols, period=period)


def current_tag_map(bridge: DataFrame, account: str | None = None) -> DataFrame:
    """One bridge row per resource, newest first; optionally of one account.

    A resource seen under two accounts keeps the newer one only. Account and
    tag key break ties.
    """
    if account is not None:
        bridge = bridge.where(F.col("line_item_usage_account_id") == account)
    order = [
        F.col("line_item_usage_start_date").desc(),
        F.col("line_item_usage_account_id"),
        F.col("tag_dim_id"),
    ]
    columns = ["line_item_resource_id", "line_item_usage_account_id", "tag_dim_id", "line_item_usage_start_date"]
    newest = latest_per(bridge.select(*columns), ["line_item_resource_id"], order)
    return newest.select("line_item_resource_id", "line_item_usage_account_id", "tag_dim_id")
