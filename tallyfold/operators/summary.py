"""Cost summary: billing lines rolled up to the per-day reporting grain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions import cost_rules as R
from tallyfold.functions.calendar import in_lookback
from tallyfold.functions.keys import PRODUCT_COLUMNS, clean_text, prefixed_columns
from tallyfold.operators.dealing import PART, dealt_by_month
from tallyfold.operators.service_names import LISTED_NAME, with_listed_name

# Summary column -> billing column, for the plain renames.
RENAMED = {
    "billing_period": "bill_billing_period_start_date",
    "payer_account_id": "bill_payer_account_id",
    "linked_account_id": "line_item_usage_account_id",
    "invoice_id": "bill_invoice_id",
    "product_sku": "product_sku",
    "charge_type": "line_item_line_item_type",
    "product_code": "line_item_product_code",
    "product_name": "product_product_name",
    "product_family": "product_product_family",
    "usage_type": "line_item_usage_type",
    "operation": "line_item_operation",
    "item_description": "line_item_line_item_description",
    "availability_zone": "line_item_availability_zone",
    "region": "product_region",
    "tenancy": "product_tenancy",
    "processor": "product_physical_processor",
    "processor_features": "product_processor_features",
    "database_engine": "product_database_engine",
    "product_group": "product_group",
    "product_from_location": "product_from_location",
    "product_to_location": "product_to_location",
    "current_generation": "product_current_generation",
    "legal_entity": "line_item_legal_entity",
    "billing_entity": "bill_billing_entity",
    "pricing_unit": "pricing_unit",
}

# The column order of the summary before measures, names and tags.
SUMMARY_KEYS = (
    "year", "month", "billing_period", "usage_date", "payer_account_id",
    "linked_account_id", "invoice_id", "product_sku", "charge_type",
    "charge_category", "purchase_option", "ri_sp_arn", "product_code",
    "product_name", "service", "product_family", "usage_type", "operation",
    "item_description", "availability_zone", "region", "instance_type_family",
    "instance_type", "platform", "tenancy", "processor", "processor_features",
    "database_engine", "product_group", "product_from_location",
    "product_to_location", "current_generation", "legal_entity",
    "billing_entity", "pricing_unit",
)

MEASURES = (
    "usage_quantity", "unblended_cost", "amortized_cost", "ri_sp_trueup",
    "ri_sp_upfront_fees", "public_cost",
)

RAW_PRODUCT_COLUMNS = tuple(c for c in PRODUCT_COLUMNS if c != "product_servicename")

# Relative standard deviation of the approximate resource count.
RESOURCE_COUNT_RSD = 0.023

# Lines for a task that adds them up where they were dealt: a group holds a sketch of 1.7 kB meanwhile.
SUMMARY_TASK_ROWS = 100_000

# Sketches of 2**12 cells: relative standard error of an estimate. They can be
# added up over days, sources and any coarser key, which counts cannot.
SKETCH_BITS = 12
SKETCH_RSD = 1.04 / 2 ** (SKETCH_BITS / 2)
SKETCH = "resource_sketch"


def recent_lines(lines: DataFrame, as_of, months: int | None) -> DataFrame:
    return lines if months is None else lines.where(in_lookback(as_of, months))


def _resource_count(how: str | None) -> dict[str, Column]:
    resource = F.col("line_item_resource_id")
    if how is None:
        return {}
    if how == "exact":
        return {"resource_id_count": F.count_distinct(resource)}
    if how == "approx":
        return {"resource_id_count": F.approx_count_distinct(resource, RESOURCE_COUNT_RSD)}
    if how == "sketch":
        return {SKETCH: F.hll_sketch_agg(resource, SKETCH_BITS)}
    raise ValueError(f"resource_count: {how!r}")


def summary(
    lines: DataFrame,
    *,
    as_of=None,
    months: int | None = 7,
    has_reservations: bool = True,
    open_month_rule: bool = False,
    tag_cols: Sequence[str] | None = None,
    product_cols: Sequence[str] = RAW_PRODUCT_COLUMNS,
    resource_count: str | None = "approx",
    resolve_names: bool = True,
    by_month: bool = False,
) -> DataFrame:
    """Summary of one source; ``months=None`` keeps the whole history.

    Rows group by the *unresolved* service name and the uncleaned tags, so
    several rows can share one resolved name. The fact adds them up.

    One shuffle. Columns that repeat another key or follow from other keys
    (category, service, resolved name, the renamed product columns) are added
    after the aggregate: they do not widen the shuffled rows, and the name
    table meets aggregated rows only. Sums combine on the map side, so a hot
    account or day costs nothing extra. ``resource_count="exact"`` takes a
    second shuffle; ``None`` leaves the count out.

    ``by_month`` has a month's rows come out in few tasks, for a write by month that
    moves them no more. It scans the lines once more, so they should be stored.
    """
    if as_of is None and (months is not None or open_month_rule):
        raise ValueError("as_of is needed for the look-back and the open-month rule")
    tags = list(prefixed_columns(lines) if tag_cols is None else tag_cols)
    extra_products = [c for c in product_cols if c not in RENAMED.values()]
    source_keys = list(RENAMED.values())
    natural = list(dict.fromkeys(["year", "month", *source_keys, "product_servicecode", *extra_products]))
    derived = {
        "usage_date": F.date_trunc("day", F.col("line_item_usage_start_date")),
        "purchase_option": R.purchase_option(has_reservations),
        "ri_sp_arn": R.commitment_arn(has_reservations),
        **R.spot_detail(),
    }
    measures = R.line_measures(has_reservations, as_of if open_month_rule else None)
    counts = _resource_count(resource_count)

    # Measures are worked out first: lines that are dealt carry them instead of the costs they come from.
    rows = recent_lines(lines, as_of, months).withColumns({f"measure_{name}": column for name, column in measures.items()})
    keys = [*natural, "product_servicename", *tags]
    fine = dealt_by_month(rows, [c for c in keys if c not in ("year", "month")], SUMMARY_TASK_ROWS) if by_month else None
    grouped = (
        (rows if fine is None else fine)
        .groupBy(
            *keys,
            *[column.alias(name) for name, column in derived.items()],
            *([] if fine is None else [PART]),
        )
        .agg(
            *[column.alias(name) for name, column in counts.items()],
            *[F.sum(f"measure_{name}").alias(name) for name in measures],
        )
    )
    if by_month and fine is None:
        grouped = grouped.hint("rebalance", "year", "month")
    named = with_listed_name(grouped) if resolve_names else grouped
    resolved = R.service_name(F.col(LISTED_NAME)) if resolve_names else F.col("product_servicename")

    outputs = {name: F.col(source) for name, source in RENAMED.items()}
    outputs |= {name: F.col(name) for name in ("year", "month", *derived)}
    outputs |= {"charge_category": R.charge_category(), "service": R.service()}
    return named.select(
        *[outputs[name].alias(name) for name in SUMMARY_KEYS],
        *counts,
        *measures,
        resolved.alias("product_servicename"),
        *[clean_text(F.col(t)).alias(t) for t in tags],
        *[F.col(c) for c in product_cols],
    )


def resource_counts(summaries: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Estimated number of resources by any keys of summaries stored with ``resource_count="sketch"``.

    A resource seen on several days or by several sources counts once, because
    sketches of equal resources merge. One shuffle of a sketch per key and task.
    """
    parts = [rows.select(*keys, SKETCH) for rows in summaries]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    merged = rows.groupBy(*keys).agg(F.hll_union_agg(SKETCH).alias(SKETCH))
    return merged.select(*keys, F.hll_sketch_estimate(SKETCH).alias("resource_id_count"))
