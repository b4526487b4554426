"""Rows dealt to tasks by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TASK_ROWS = 1_000_000


def dealt(df: DataFrame, rows: int, task_rows: int, *by: str | Column) -> DataFrame:
    """Rows of equal ``by`` together, in tasks bounded by rows."""
    tasks = -(-rows // task_rows)
    if tasks <= df.sparkSession.sparkContext.defaultParallelism:
        return df.repartition(*by)
    return df.repartition(tasks, *by)


# A roll-up with more groups than one for so many lines is added up where its lines are dealt.
FINE_LINES = 4

# Parts of months for one task, so that tasks come out about equal.
TASK_PARTS = 4

PART = "deal_part"


def dealt_by_month(lines: DataFrame, keys: Sequence[str | Column], task_rows: int) -> DataFrame | None:
    """Lines dealt by year, month and ``PART``, a number that follows from ``keys``; None if the roll-up is coarse.

    Grouped by ``keys``, year, month and ``PART``, lines are added up where they lie, and a month's
    groups lie in few tasks for the write: one shuffle in all. Where groups hold many lines each,
    sums on the map side move less, so lines stay where they are. One more scan of the lines
    counts them and, about, their months and groups.
    """
    months = [F.col("year"), F.col("month")]
    found = lines.agg(
        F.count("*").alias("rows"),
        F.approx_count_distinct(F.xxhash64(*months)).alias("months"),
        F.approx_count_distinct(F.xxhash64(*months, *keys)).alias("groups"),
    ).first()
    if found["groups"] * FINE_LINES <= found["rows"]:
        return None
    parts = max(1, -(-found["rows"] * TASK_PARTS // (task_rows * max(1, found["months"]))))
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).alias(PART)
    return dealt(lines.select("*", part), found["rows"], task_rows, *months, PART)
