"""Declared input schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of a billing line, grouped by type. Names are
# matched without regard to case.
BILLING_TIMESTAMPS = """
bill_billing_period_start_date bill_billing_period_end_date
line_item_usage_start_date line_item_usage_end_date
""".split()

BILLING_DOUBLES = """
line_item_usage_amount line_item_normalization_factor
line_item_normalized_usage_amount line_item_unblended_cost
line_item_blended_cost pricing_public_on_demand_cost
reservation_amortized_upfront_cost_for_usage
reservation_amortized_upfront_fee_for_billing_period
reservation_effective_cost reservation_recurring_fee_for_usage
reservation_unused_amortized_upfront_fee_for_billing_period
reservation_unused_normalized_unit_quantity reservation_unused_quantity
reservation_unused_recurring_fee reservation_upfront_value
savings_plan_total_commitment_to_date savings_plan_savings_plan_rate
savings_plan_used_commitment savings_plan_savings_plan_effective_cost
savings_plan_amortized_upfront_commitment_for_billing_period
savings_plan_recurring_commitment_for_billing_period
""".split()

BILLING_STRINGS = """
identity_line_item_id identity_time_interval
bill_invoice_id bill_billing_entity bill_bill_type bill_payer_account_id
line_item_usage_account_id line_item_line_item_type line_item_product_code
line_item_usage_type line_item_operation line_item_availability_zone
line_item_resource_id line_item_currency_code line_item_unblended_rate
line_item_blended_rate line_item_line_item_description line_item_tax_type
line_item_legal_entity
product_product_name product_from_location product_from_location_type
product_from_region_code product_group product_group_description
product_location product_location_type product_product_family product_region
product_region_code product_servicecode product_servicename product_sku
product_storage_media product_to_location product_to_location_type
product_to_region_code product_transfer_type product_version
pricing_rate_code pricing_rate_id pricing_currency
pricing_public_on_demand_rate pricing_term pricing_unit
reservation_end_time reservation_modification_status
reservation_normalized_units_per_reservation
reservation_number_of_reservations reservation_start_time
reservation_subscription_id reservation_total_reserved_normalized_units
reservation_total_reserved_units reservation_units_per_reservation
savings_plan_savings_plan_a_r_n
""".split()

# Columns the summary reads beyond the declared ones.
BILLING_EXTRA_STRINGS = """
reservation_reservation_a_r_n
product_instance_type_family product_instance_type product_operating_system
product_tenancy product_physical_processor product_processor_features
product_database_engine product_current_generation
""".split()

TAG_PREFIX = "resource_tags_user_"


def billing_schema(tag_columns: list[str] | tuple[str, ...] = (), *, extra: bool = True) -> T.StructType:
    """Schema of one billing line; ``year`` and ``month`` come from the path."""
    fields = [T.StructField(name, T.StringType()) for name in BILLING_STRINGS]
    fields += [T.StructField(name, T.DoubleType()) for name in BILLING_DOUBLES]
    fields += [T.StructField(name, T.TimestampType()) for name in BILLING_TIMESTAMPS]
    if extra:
        fields += [T.StructField(name, T.StringType()) for name in BILLING_EXTRA_STRINGS]
    fields += [T.StructField(name, T.StringType()) for name in tag_columns]
    return T.StructType(fields)


METRIC_VALUE = T.StructType([T.StructField(name, T.DoubleType()) for name in ("min", "max", "sum", "count")])

# ``dimensions`` is a JSON object in the files. Reading it as a string keeps
# the raw text, which is what get_json_object needs later.
METRIC_SCHEMA = T.StructType(
    [
        T.StructField("metric_stream_name", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("namespace", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("dimensions", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("value", METRIC_VALUE),
        T.StructField("unit", T.StringType()),
        T.StructField("record_id", T.StringType()),
    ]
)

# The metric table: its folders, and what tells one record from another. Two
# deliveries of a record agree in all of it, whatever stream brought them. A
# source that reports several records of one metric and millisecond tells them
# apart by ``record_id``, in every delivery; elsewhere it is null or absent.
METRIC_ID = "record_id"
METRIC_PARTITIONS = ("namespace", "year", "month", "day", "hour")
METRIC_BATCH = "batch"
METRIC_GENERATION = "generation"
METRIC_RECORD = ("account_id", "region", "namespace", "metric_name", "dimensions", "unit", "timestamp", METRIC_ID)


def as_text(schema: T.StructType) -> T.StructType:
    """The schema with text in place of every simple type, for files whose
    writers disagree about types."""
    return T.StructType(
        [
            T.StructField(f.name, as_text(f.dataType) if isinstance(f.dataType, T.StructType) else T.StringType())
            for f in schema.fields
        ]
    )
