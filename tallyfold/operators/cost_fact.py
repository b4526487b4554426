"""Cost fact: summaries (or billing lines) at the star-schema grain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions import cost_rules as R
from tallyfold.functions.calendar import date_dim_id
from tallyfold.functions.keys import (
    PRODUCT_COLUMNS,
    clean_text,
    prefixed_columns,
    surrogate_key,
    with_clean_columns,
)
from tallyfold.operators.dealing import PART, TASK_ROWS, dealt, dealt_by_month
from tallyfold.operators.service_names import LISTED_NAME, with_listed_name
from tallyfold.operators.summary import recent_lines

FACT_MEASURES = ("amortized_cost", "unblended_cost", "ri_sp_trueup", "ri_sp_upfront_fees", "public_cost")

FACT_KEYS = (
    "aws_account_dim_id", "date_dim_id", "charge_type", "purchase_option",
    "charge_category", "product_code",
)


def fact_lines(
    lines: DataFrame,
    *,
    as_of=None,
    months: int | None = None,
    has_reservations: bool = True,
    open_month_rule: bool = False,
    tag_cols: Sequence[str] | None = None,
    resolve_names: bool = True,
) -> DataFrame:
    """Billing lines with the columns ``cost_fact`` reads from a summary.

    Adding up lines gives the same fact as adding up summary rows, so this
    skips the summary's shuffle when only the fact is wanted.
    """
    tags = list(prefixed_columns(lines) if tag_cols is None else tag_cols)
    measures = R.line_measures(has_reservations, as_of if open_month_rule else None)
    rows = with_clean_columns(recent_lines(lines, as_of, months), tags)
    if resolve_names:
        rows, name = with_listed_name(rows), R.service_name(F.col(LISTED_NAME))
    else:
        name = F.col("product_servicename")
    return rows.select(
        "year",
        "month",
        F.date_trunc("day", F.col("line_item_usage_start_date")).alias("usage_date"),
        F.col("bill_payer_account_id").alias("payer_account_id"),
        F.col("line_item_usage_account_id").alias("linked_account_id"),
        F.col("line_item_line_item_type").alias("charge_type"),
        R.purchase_option(has_reservations).alias("purchase_option"),
        R.charge_category().alias("charge_category"),
        F.col("line_item_product_code").alias("product_code"),
        *[F.col(c) for c in PRODUCT_COLUMNS if c != "product_servicename"],
        name.alias("product_servicename"),
        *tags,
        *[measures[name].alias(name) for name in FACT_MEASURES],
    )


def product_lines(lines: DataFrame) -> DataFrame:
    """Billing lines with the resolved columns of the product dimension alone."""
    name = R.service_name(F.col(LISTED_NAME)).alias("product_servicename")
    others = [c for c in PRODUCT_COLUMNS if c != "product_servicename"]
    return with_listed_name(lines).select("year", "month", *others, name)


# By these a bill's month lies in a dozen tasks, for a fact that is written by month.
FACT_DEAL = ("year", "month", "charge_type")

FACT_COLUMNS = (*FACT_KEYS, *FACT_MEASURES, "tag_dim_id", "aws_product_dim_id", "year", "month")


def _in_period(rows: DataFrame, period: tuple[int, int] | None) -> DataFrame:
    if period is None:
        return rows
    year, month = period
    return rows.where((F.col("year") == int(year)) & (F.col("month") == int(month)))


def _at_fact_grain(rows: DataFrame, tag_cols: Sequence[str], *, extra: Sequence[str] = ()) -> DataFrame:
    return with_clean_columns(rows, tag_cols).select(
        *extra,
        "year",
        "month",
        F.col("linked_account_id").alias("aws_account_dim_id"),
        F.to_date("usage_date").alias("usage_day"),
        "charge_type",
        "purchase_option",
        "charge_category",
        "product_code",
        *[clean_text(F.col(c)).alias(c) for c in PRODUCT_COLUMNS],
        *tag_cols,
        *FACT_MEASURES,
    )


def _with_keys(rows: DataFrame, tag_cols: Sequence[str]) -> DataFrame:
    return rows.withColumns(
        {
            "date_dim_id": date_dim_id(F.col("usage_day")),
            "tag_dim_id": surrogate_key(tag_cols),
            "aws_product_dim_id": surrogate_key(PRODUCT_COLUMNS),
        }
    ).select(*FACT_COLUMNS)


def _sums_by_key(
    grain: DataFrame, tag_cols: Sequence[str], *, deal_rows: int | None = None, by_month: bool = False
) -> DataFrame:
    """The grain added up, with hex keys.

    Rows are added up and shuffled with the 32 bytes of the product key in place of
    its six texts, which are more than half of a row of the aggregate. Equal keys
    are equal texts, as they are in the fact itself. Tags are few and short.

    Given their number, ``deal_rows``, rows are dealt by ``FACT_DEAL`` and added up there.
    ``by_month`` looks whether that moves less, and else moves the sums as a write by month needs them.
    """
    product = F.unhex(surrogate_key(PRODUCT_COLUMNS)).alias("aws_product_dim_id")
    rows = grain.select(*[c for c in grain.columns if c not in PRODUCT_COLUMNS], product)
    keys = [c for c in rows.columns if c not in FACT_MEASURES]
    fine = dealt_by_month(rows, [c for c in keys if c not in ("year", "month")], TASK_ROWS) if by_month else None
    if fine is not None:
        rows, keys = fine, [*keys, PART]
    elif deal_rows is not None:
        rows = dealt(rows, deal_rows, TASK_ROWS, *FACT_DEAL)
    sums = rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in FACT_MEASURES])
    if by_month and fine is None:
        sums = sums.hint("rebalance", "year", "month")
    return sums.withColumns(
        {
            "date_dim_id": date_dim_id(F.col("usage_day")),
            "tag_dim_id": surrogate_key(tag_cols),
            "aws_product_dim_id": F.lower(F.hex("aws_product_dim_id")),
        }
    ).select(*FACT_COLUMNS)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def cost_fact(
    summaries: Sequence[DataFrame],
    *,
    tag_cols: Sequence[str],
    period: tuple[int, int] | None = None,
    by_month: bool = False,
) -> DataFrame:
    """Cost fact over all sources, optionally of one (year, month).

    ``tag_cols`` is the tag list of *all* sources together, so equal tags get
    equal keys whichever source they come from; a source without a tag counts
    it as ''. Nulls in product columns become '' before grouping, which is
    also how the key and the product dimension treat them.

    Each source is one shuffle with map-side sums, of rows with the product key;
    the tag key is hashed after it, on aggregated rows.

    ``by_month`` has a month's rows come out in few tasks, for a write by month that
    moves them no more. It scans the rows once more, so they should be stored.
    """
    parts = []
    for rows in summaries:
        parts.append(_sums_by_key(_at_fact_grain(_in_period(rows, period), tag_cols), tag_cols, by_month=by_month))
    return _union(parts)


def cost_fact_view(
    summaries: Sequence[DataFrame],
    *,
    tag_cols: Sequence[str],
    period: tuple[int, int] | None = None,
) -> DataFrame:
    """The fact's columns without adding rows up.

    A report adds up by its own few keys anyway, so over a fact that is not
    stored this saves the shuffle at the fact's wide grain, and keys the
    report does not use are never hashed.
    """
    return _union([_with_keys(_at_fact_grain(_in_period(rows, period), tag_cols), tag_cols) for rows in summaries])


BASE_EXTRA = ("source", "payer_account_id")


def star_base(
    lines: Sequence[DataFrame], *, tag_cols: Sequence[str], period: tuple[int, int] | None = None
) -> DataFrame:
    """What fact and dimensions follow from: sums at the fact's grain by natural columns, source and payer.

    ``lines`` come from ``fact_lines``. One shuffle per source with map-side
    sums; no key is hashed yet. ``period`` applies to all that is built on it.
    """
    parts = []
    for number, rows in enumerate(lines):
        numbered = _in_period(rows, period).withColumn("source", F.lit(number))
        grain = _at_fact_grain(numbered, tag_cols, extra=BASE_EXTRA)
        keys = [c for c in grain.columns if c not in FACT_MEASURES]
        parts.append(grain.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in FACT_MEASURES]))
    return _union(parts)


def fact_of_base(base: DataFrame, tag_cols: Sequence[str]) -> DataFrame:
    """The cost fact: the base's rows of all payers added up, per source.

    The base is stored, so its rows are counted from the files' footers. The fact's
    rows lie by month as a write needs them.
    """
    return _sums_by_key(base.drop("payer_account_id"), tag_cols, deal_rows=base.count())
