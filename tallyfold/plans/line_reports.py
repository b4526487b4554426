"""Reports straight from billing lines, and reconciliation with the fact."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions import cost_rules as R
from tallyfold.functions.calendar import date_dim_id
from tallyfold.functions.fixed_values import NON_USAGE_CHARGES
from tallyfold.plans.star import PRODUCT_KEY, Star

COST = "amortized_cost"
DAY = "date_dim_id"


def usage_lines(
    lines: DataFrame,
    *tests: Column,
    year: int | None = None,
    month: int | None = None,
    account: str | None = None,
    days: Iterable[str] | None = None,
    excluded: Sequence[str] = NON_USAGE_CHARGES,
) -> DataFrame:
    """Lines of a month, account or list of days, without some charge types.

    ``year`` and ``month`` are partition columns and prune the scan.
    """
    chosen = lines.where(~F.col(R.CHARGE).isin(*excluded)) if excluded else lines
    for name, value in (("year", year), ("month", month), ("line_item_usage_account_id", account)):
        if value is not None:
            chosen = chosen.where(F.col(name) == value)
    if days is not None:
        chosen = chosen.where(date_dim_id(F.col("line_item_usage_start_date")).isin(*days))
    for test in tests:
        chosen = chosen.where(test)
    return chosen


def amortized_by(lines: DataFrame, *by: str | Column, extra: Sequence[Column] = ()) -> DataFrame:
    return lines.groupBy(*by).agg(F.sum(R.amortized_cost()).alias(COST), *extra)


def _day() -> Column:
    return date_dim_id(F.col("line_item_usage_start_date")).alias(DAY)


def by_account_and_day(lines: DataFrame) -> DataFrame:
    """R17. Amortized cost of named services per account and day."""
    named = lines.where(F.col("product_servicename") != "")
    return amortized_by(named, "line_item_usage_account_id", _day()).orderBy(DAY, F.desc(COST))


def service_or_code(service: str, code: str) -> Column:
    """A service by its name, or by its code when the name is empty."""
    name = F.col("product_servicename")
    return (name == service) | ((name == "") & (F.col("line_item_product_code") == code))


def by_day(lines: DataFrame) -> DataFrame:
    """R18. Amortized cost per day."""
    return amortized_by(lines, _day()).orderBy(DAY)


def by_usage_type_and_operation(lines: DataFrame) -> DataFrame:
    """R19. With the reservation cost, per day, usage type and operation."""
    reservation = F.sum("reservation_effective_cost").alias("reservation_cost")
    grouped = amortized_by(lines, _day(), "line_item_usage_type", "line_item_operation", extra=[reservation])
    return grouped.orderBy(DAY, F.desc(COST))


def by_columns(lines: DataFrame, *columns: str) -> DataFrame:
    """R20. Per service, service and code, or tags; highest first."""
    return amortized_by(lines, *columns).orderBy(F.desc(COST))


def distinct_values(df: DataFrame, column: str, *tests: Column, limit: int | None = None, descending: bool = False) -> DataFrame:
    """R21, R23. Distinct values of a column under filters, sorted."""
    chosen = df
    for test in tests:
        chosen = chosen.where(test)
    values = chosen.select(column).distinct().orderBy(F.desc(column) if descending else F.asc(column))
    return values if limit is None else values.limit(limit)


def find_lines(df: DataFrame, *tests: Column, columns: Sequence[str] = (), limit: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """R22. Lines (or summary rows) matching every test."""
    chosen = df
    for test in tests:
        chosen = chosen.where(test)
    if columns:
        chosen = chosen.select(*columns)
    if order:
        chosen = chosen.orderBy(*order)
    return chosen if limit is None else chosen.limit(limit)


def reconcile(lines: DataFrame, star: Star, *, service: str, code: str) -> DataFrame:
    """Q1. One service per day: from the lines by name or code, from the fact
    by resolved name, and the difference. A day missing on one side counts 0
    there. Two small per-day results meet in the join."""
    from_lines = amortized_by(usage_lines(lines, service_or_code(service, code)), _day())
    rows = star.fact.where(~F.col("charge_type").isin(*NON_USAGE_CHARGES))
    per_product = rows.groupBy(DAY, PRODUCT_KEY).agg(F.sum(COST).alias(COST))
    from_fact = (
        per_product.join(star.product.where(F.col("product_servicename") == service), PRODUCT_KEY)
        .groupBy(DAY)
        .agg(F.sum(COST).alias(COST))
    )
    left, right = from_lines.withColumnRenamed(COST, "from_lines"), from_fact.withColumnRenamed(COST, "from_fact")
    return (
        left.join(right, DAY, "full")
        .na.fill(0.0, ["from_lines", "from_fact"])
        .withColumn("difference", F.col("from_lines") - F.col("from_fact"))
    )
