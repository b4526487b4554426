"""Date, account, tag and product dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.calendar import date_dim_id
from tallyfold.functions.keys import surrogate_key, with_clean_columns

MODES = ("full", "month", "delta")


def _check_mode(mode: str, existing: DataFrame | None, period) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "delta" and existing is None:
        raise ValueError("delta mode needs the existing dimension")
    if mode == "month" and period is None:
        raise ValueError("month mode needs a (year, month) period")


def _in_period(df: DataFrame, period: tuple[int, int] | None) -> DataFrame:
    if period is None:
        return df
    year, month = period
    return df.where((F.col("year") == int(year)) & (F.col("month") == int(month)))


def _union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _date_attributes(day: Column) -> list[Column]:
    return [
        date_dim_id(day).alias("date_dim_id"),
        F.date_format(day, "dd").alias("day_attr"),
        F.date_format(day, "MM").alias("month_attr"),
        F.date_format(day, "yyyy").alias("year_attr"),
    ]


def date_dim(lines: DataFrame) -> DataFrame:
    """One row per day from the first to the last usage day, plus one more."""
    span = lines.agg(
        F.min("line_item_usage_start_date").cast("date").alias("first_day"),
        F.max("line_item_usage_start_date").cast("date").alias("last_day"),
    ).where(F.col("first_day").isNotNull())
    days = span.select(F.explode(F.sequence("first_day", F.date_add("last_day", 1))).alias("day"))
    return days.select(*_date_attributes(F.col("day")))


def date_dim_add(dim: DataFrame, day: Column) -> DataFrame:
    """The row for ``day``, or nothing when the dimension has it already."""
    row = dim.sparkSession.range(1).select(*_date_attributes(day.cast("date")))
    return row.join(dim.select("date_dim_id"), "date_dim_id", "left_anti").select(*row.columns)


def _with_account_name(accounts: DataFrame, directories: Sequence[DataFrame]) -> DataFrame:
    """First non-empty name over the directories in order, else ''."""
    named, found = accounts, []
    for position, directory in enumerate(directories):
        name = f"_name_{position}"
        lookup = directory.select(
            F.col("account_id").alias("aws_account_dim_id"), F.col("account_name").alias(name)
        )
        named = named.join(lookup, "aws_account_dim_id", "left")
        found.append(F.nullif(F.col(name), F.lit("")))
    return named.select(*accounts.columns, F.coalesce(*found, F.lit("")).alias("account_name"))


def account_dim(
    sources: Sequence[DataFrame],
    names: Sequence[DataFrame],
    *,
    mode: str = "full",
    existing: DataFrame | None = None,
    period: tuple[int, int] | None = None,
) -> DataFrame:
    """Distinct (payer, account) pairs of all sources with account names.

    ``names`` are directories (account_id, account_name), unique by account,
    asked in order. ``full`` returns the whole dimension, ``month`` the pairs
    of one month, ``delta`` the pairs whose account is not in ``existing``.

    The pairs are made distinct first (map-side, two short columns); names and
    the anti-join only see that small result.
    """
    _check_mode(mode, existing, period)
    pairs = _union_all(
        [
            _in_period(s, period).select(
                "bill_payer_account_id",
                "line_item_usage_account_id",
                F.col("line_item_usage_account_id").alias("aws_account_dim_id"),
            )
            for s in sources
        ]
    ).distinct()
    if mode == "delta":
        pairs = pairs.join(existing.select("line_item_usage_account_id"), "line_item_usage_account_id", "left_anti")
    ordered = pairs.select("bill_payer_account_id", "line_item_usage_account_id", "aws_account_dim_id")
    return _with_account_name(ordered, names)


def hashed_dim(
    sources: Sequence[DataFrame],
    cols: Sequence[str],
    key_name: str,
    *,
    mode: str = "full",
    existing: DataFrame | None = None,
    period: tuple[int, int] | None = None,
) -> DataFrame:
    """Distinct value combinations of ``cols`` with their surrogate key.

    Used for the tag dimension (all tag columns) and the product dimension
    (six product columns). Values are cleaned *before* ``distinct`` so that a
    key occurs once; a source lacking a column counts it as ''. Modes as in
    ``account_dim``; ``delta`` compares keys, so unchanged input adds nothing.

    One shuffle of combinations already made distinct on the map side; the
    hash is computed once per combination.
    """
    _check_mode(mode, existing, period)
    cols = sorted(cols)
    rows = [with_clean_columns(_in_period(s, period), cols).select(*cols) for s in sources]
    keyed = _union_all(rows).distinct().withColumn(key_name, surrogate_key(cols))
    if mode == "delta":
        keyed = keyed.join(existing.select(key_name), key_name, "left_anti").select(*cols, key_name)
    return keyed


def unknown_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact keys the dimension lacks (none, when both use the same columns)."""
    return fact.select(key).distinct().join(dim.select(key), key, "left_anti")

