"""Billing lines, metric records and the rest, derived from the given tables.

The given tables hold orders and events, not a cloud bill, so every input is a
projection of them that reaches each branch of the rules. ``oracle.py`` spells
the same expressions out in its own SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyfold.operators.dealing import TASK_ROWS, dealt
from tallyfold.operators.latest import latest_tags
from tallyfold.operators.usage import MetricSpec, normalize_metrics
from tallyfold.plans.star import Source, Star, load_star
from tallyfold.schemas import METRIC_ID
from tallyfold.session import apply_session_conf, shared_work_dir

AS_OF = "2001-08-15"
TAGS_ONE = ["resource_tags_user_component", "resource_tags_user_name", "resource_tags_user_squad"]
TAGS_TWO = ["resource_tags_user_component", "resource_tags_user_owner", "resource_tags_user_squad"]
TIE_BREAK = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

EMPTY_COLUMNS = """
line_item_availability_zone product_physical_processor product_processor_features
product_database_engine product_group product_from_location product_to_location
product_current_generation
""".split()

CONSTANT_COLUMNS = {
    "product_instance_type": "m5.xlarge",
    "product_instance_type_family": "m5",
    "product_operating_system": "Linux",
    "product_tenancy": "Shared",
    "line_item_legal_entity": "Entity",
    "pricing_unit": "Hrs",
    "line_item_unblended_rate": "1.5",
    "line_item_blended_rate": "1.4",
}

# The nation of a line, as ``n_nationkey``.
NATION_KEY = "cast((l_partkey % 200) % 25 as int)"

LINE_SQL = {
    "identity_line_item_id": "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), cast(l_suppkey as string))",
    "year": "year(ship)",
    "month": "month(ship)",
    "bill_billing_period_start_date": "date_trunc('month', ship)",
    "bill_payer_account_id": "concat('P', n_regionkey)",
    "bill_invoice_id": "concat('INV', l_orderkey % 100)",
    "bill_billing_entity": "case when l_orderkey % 10 = 0 then 'AWS Marketplace' else 'AWS' end",
    "line_item_usage_account_id": f"concat('A', {NATION_KEY})",
    "line_item_usage_start_date": "ship",
    "line_item_line_item_type": """case (l_orderkey + l_linenumber) % 12
        when 2 then 'Credit' when 3 then 'SavingsPlanCoveredUsage' when 4 then 'DiscountedUsage'
        when 5 then 'RIFee' when 6 then 'SavingsPlanRecurringFee' when 7 then 'SavingsPlanNegation'
        when 8 then 'SavingsPlanUpfrontFee' when 9 then 'Fee' when 10 then 'Tax' when 11 then 'Refund'
        else 'Usage' end""",
    "line_item_product_code": """case l_partkey % 8 when 0 then 'AmazonEC2' when 1 then 'AmazonRDS'
        when 2 then 'AmazonS3' when 3 then 'AmazonElastiCache' when 4 then 'AmazonRedshift'
        when 5 then 'AmazonGlacier' when 6 then 'OCBElasticComputeCloud' else 'UnlistedCode' end""",
    "product_servicename": """case l_suppkey % 3 when 0 then 'AWS Data Transfer' when 1 then ''
        else concat('Service ', p_brand) end""",
    "product_servicecode": "case when l_suppkey % 4 = 0 then '' else p_brand end",
    "product_product_name": """case l_orderkey % 3 when 0 then 'Amazon Simple Storage Service'
        when 1 then 'Amazon CloudFront' else p_name end""",
    "product_product_family": "p_type",
    "product_region": "case when o_orderpriority = '5-LOW' then null else n_name end",
    "product_sku": "concat('SKU', l_partkey % 30)",
    "line_item_operation": "concat('Op', l_linenumber)",
    "line_item_usage_type": """case (l_partkey + l_suppkey) % 8 when 0 then 'SpotUsage:m5.large'
        when 1 then 'TimedStorage-ByteHrs' when 2 then 'TimedStorage-GlacierByteHrs'
        when 3 then 'US-Requests-HTTP-Proxy' when 4 then 'US-Requests-HTTPS-Proxy'
        when 5 then 'US-DataTransfer-Out-Bytes' when 6 then 'US-DataTransfer-Regional-Bytes'
        else 'BoxUsage:m5.xlarge' end""",
    "line_item_line_item_description": """case when (l_partkey + l_suppkey) % 8 = 0 then 'm5.large Linux/UNIX Spot Instance-hour'
        when l_linenumber = 1 then 'Enterprise Program Discount' else 'plain' end""",
    "line_item_resource_id": """case when l_partkey % 10 = 0 then ''
        else concat('arn:aws:svc:reg:acct:instance/i-', l_partkey % 200) end""",
    "line_item_usage_amount": "cast(l_quantity as double)",
    "line_item_unblended_cost": "l_extendedprice",
    "line_item_blended_cost": "l_extendedprice * 0.9D",
    "pricing_public_on_demand_cost": "l_extendedprice * 1.2D",
    "reservation_reservation_a_r_n": """case l_linenumber % 3 when 0 then concat('arn:ri/', l_suppkey)
        when 1 then '' else null end""",
    "reservation_effective_cost": "l_extendedprice * (1 - l_discount)",
    "reservation_unused_amortized_upfront_fee_for_billing_period": "l_extendedprice * 0.1D",
    "reservation_unused_recurring_fee": "l_extendedprice * 0.05D",
    "reservation_amortized_upfront_fee_for_billing_period": "l_extendedprice * 0.2D",
    "savings_plan_savings_plan_a_r_n": "case when l_orderkey % 5 = 0 then concat('arn:sp/', l_suppkey) else '' end",
    "savings_plan_savings_plan_effective_cost": "l_extendedprice * 0.7D",
    "savings_plan_total_commitment_to_date": "l_extendedprice",
    "savings_plan_used_commitment": "l_extendedprice * 0.8D",
    "savings_plan_amortized_upfront_commitment_for_billing_period": "l_extendedprice * 0.15D",
    "resource_tags_user_component": """case o_orderpriority when '4-NOT SPECIFIED' then null
        when '3-MEDIUM' then '' else o_orderpriority end""",
    "resource_tags_user_name": "concat('svc-', l_partkey % 20)",
    "resource_tags_user_squad": "c_mktsegment",
}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the footer once; naming it on
    later reads saves a job each time."""
    apply_session_conf(spark)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


# Of lines at their full width, behind which roll-ups by many columns follow.
WIDE_TASK_ROWS = 250_000

# Billing columns that the grains of summary, fact and star hold unchanged. Lines dealt
# by them are added up where they are, and so cross the network before they are widened.
GRAIN = (
    "year", "month", "line_item_usage_account_id", "line_item_line_item_type", "line_item_product_code",
)

# Columns of that kind by which a month lies in a dozen tasks, for summaries stored by month.
MONTH_GRAIN = ("year", "month", "line_item_line_item_type")


def spread_out(df: DataFrame, key: str) -> DataFrame:
    """Rows over all tasks by a key, whatever the number of files they came in.

    Rows become several times wider behind it, so tasks are bounded by rows: merged
    by bytes, they would take up to a million and a half narrow rows each. The count
    comes from the files' footers.
    """
    return dealt(df, df.count(), TASK_ROWS, key)


# One more part of each month for as many lines of the whole export.
MONTH_PART_LINES = 5_000_000


def billing_lines(spark: SparkSession, sf_dir: str, by: Sequence[str] = (), by_month: bool = False) -> DataFrame:
    """All line items as billing lines of source 1, on request dealt by billing columns.

    Orders take their customer's column before they meet the lines, which move for
    orders and parts only. ``by`` deals the joined rows, a third as wide as lines;
    ``by_month`` deals and sorts them for a write by year and month. Nations are
    few, so their columns are joined to rows that move no more.
    """
    given = table(spark, sf_dir, "lineitem")
    rows = given.count()
    lineitem = dealt(given, rows, TASK_ROWS, "l_orderkey").withColumn("ship", F.col("l_shipdate").cast("timestamp"))
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    if by:
        joined = dealt(joined, rows, WIDE_TASK_ROWS, *[F.expr(LINE_SQL[name]) for name in by])
    if by_month:
        months = [F.expr(LINE_SQL[name]) for name in ("year", "month")]
        part = F.col("l_orderkey") % -(-rows // MONTH_PART_LINES)
        joined = dealt(joined, rows, WIDE_TASK_ROWS, *months, part).sortWithinPartitions(*months)
    joined = joined.join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.expr(NATION_KEY))
    return joined.select(
        *TIE_BREAK,
        *[F.expr(text).alias(name) for name, text in LINE_SQL.items()],
        *[F.lit(value).alias(name) for name, value in CONSTANT_COLUMNS.items()],
        *[F.lit("").alias(name) for name in EMPTY_COLUMNS],
    )


# Few values per column, so that the roll-ups add many lines up; both dialects.
COARSE_SQL = {
    "bill_payer_account_id": "concat('P', l_orderkey % 2)",
    "bill_invoice_id": "'INV'",
    "bill_billing_entity": "'AWS'",
    "line_item_usage_account_id": "concat('A', l_suppkey % 2)",
    "line_item_line_item_type": "case l_orderkey % 3 when 0 then 'Usage' when 1 then 'Credit' else 'DiscountedUsage' end",
    "line_item_product_code": "case l_partkey % 2 when 0 then 'AmazonEC2' else 'UnlistedCode' end",
    "product_servicename": "case l_suppkey % 2 when 0 then 'AWS Data Transfer' else 'Service' end",
    "product_servicecode": "'code'",
    "product_product_name": "'Amazon CloudFront'",
    "product_product_family": "'family'",
    "product_region": "case l_partkey % 2 when 0 then null else '' end",
    "product_sku": "'SKU'",
    "line_item_operation": "'Op'",
    "line_item_usage_type": "case l_partkey % 2 when 0 then 'SpotUsage:m5.large' else 'BoxUsage:m5.xlarge' end",
    "line_item_line_item_description": "'plain'",
    "reservation_reservation_a_r_n": "case l_suppkey % 2 when 0 then 'arn:ri/1' else '' end",
    "savings_plan_savings_plan_a_r_n": "''",
    "resource_tags_user_component": "case l_suppkey % 2 when 0 then '' else null end",
    "resource_tags_user_name": "'svc'",
    "resource_tags_user_squad": "concat('squad-', l_partkey % 2)",
}


def coarse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing lines of two days a month at any hour, with few distinct values
    and accounts under two payers."""
    start = "line_item_usage_start_date"
    hours = F.col("l_orderkey") % 24 + 336 * (F.day(start) % 2)
    hour = F.timestamp_add("HOUR", hours.cast("int"), F.date_trunc("month", start))
    return billing_lines(spark, sf_dir).withColumns(
        {start: hour, **{name: F.expr(text) for name, text in COARSE_SQL.items()}}
    )


def as_source_two(lines: DataFrame) -> DataFrame:
    """The second export's shape: no reservation identifier, other tags."""
    return lines.drop("reservation_reservation_a_r_n", "resource_tags_user_name").withColumn(
        "resource_tags_user_owner", F.concat(F.lit("own-"), F.col("l_linenumber"))
    )


def two_sources(spark: SparkSession, sf_dir: str, by: Sequence[str] = ()) -> list[Source]:
    """Every line in exactly one of two payer exports."""
    lines = billing_lines(spark, sf_dir, by)
    second = F.col("l_suppkey") % 4 == 3
    return [Source(lines.where(~second)), Source(as_source_two(lines.where(second)), has_reservations=False)]


def account_directories(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two directories of account names; the second knows more accounts."""
    nation = table(spark, sf_dir, "nation")

    def directory(limit: int) -> DataFrame:
        return nation.where(F.col("n_nationkey") < limit).select(
            F.concat(F.lit("A"), "n_nationkey").alias("account_id"), F.col("n_name").alias("account_name")
        )

    return [directory(15), directory(20)]


def raw_metrics(spark: SparkSession, sf_dir: str, spec: MetricSpec) -> DataFrame:
    """All events as landed metric records of one service."""
    events = spread_out(table(spark, sf_dir, "events"), "event_id")
    kinds = ("click", "view", "purchase")
    name = F.col("event_type")
    for kind, metric in zip(kinds, spec.metrics):
        name = F.when(F.col("event_type") == kind, metric).otherwise(name)
    prefix = "app/lb/i-" if spec.id_is_path else "i-"
    user = (F.col("user_id") % 20).cast("string")
    value = F.col("value")
    return events.select(
        F.lit("stream").alias("metric_stream_name"),
        F.concat(F.lit("A"), user).alias("account_id"),
        F.lit("region-1").alias("region"),
        F.lit(spec.namespace.replace("AWS", "AWS/", 1)).alias("namespace"),
        name.alias("metric_name"),
        F.concat(F.lit(f'{{"{spec.json_key}":"{prefix}'), user, F.lit('"}')).alias("dimensions"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.struct(
            (value * 0.5).alias("min"),
            (value * 1.5).alias("max"),
            (value * (1 + F.col("event_id") % 3)).alias("sum"),
            (F.col("event_id") % 5).cast("double").alias("count"),
        ).alias("value"),
        F.lit("Percent").alias("unit"),
        # Events of one millisecond differ in nothing else that a record holds.
        F.col("event_id").cast("string").alias(METRIC_ID),
    )


def metric_records(spark: SparkSession, sf_dir: str, spec: MetricSpec) -> DataFrame:
    return normalize_metrics(raw_metrics(spark, sf_dir, spec))


def tag_bridge(spark: SparkSession, sf_dir: str, period: tuple[int, int] | None = None) -> DataFrame:
    return latest_tags(
        billing_lines(spark, sf_dir), TAGS_ONE, tie_break=[F.col(c) for c in TIE_BREAK], period=period
    )


def event_days(spark: SparkSession, sf_dir: str, by: Sequence[str] = ("event_type",)) -> DataFrame:
    """Events per day and kind: the basis of the commitment responses."""
    day = F.col("ts").cast("date")
    return (
        table(spark, sf_dir, "events")
        .groupBy(day.alias("day"), *by)
        .agg(F.round(F.sum("value"), 2).alias("used"), F.round(F.avg("value"), 2).alias("share"))
    )


def plain_text(column: str) -> Column:
    """A number of at most two decimals as responses write it: without an exponent
    (which Spark's cast gives from ten million on), and with one decimal at least."""
    return F.regexp_replace(F.col(column).cast("decimal(38,2)").cast("string"), r"(\.\d)0$", "$1")


def commitment_responses(spark: SparkSession, sf_dir: str, member: str, *, coverage: bool) -> dict[str, DataFrame]:
    """One landed response per service: a document holding its series."""
    kinds = {"AMAZON EC2": "click", "AMAZON RDS": "view", "AMAZON REDSHIFT": "purchase", "AMAZON ELASTICACHE": "error"}
    days = event_days(spark, sf_dir)
    period = F.struct(
        F.col("day").cast("string").alias("Start"), F.date_add("day", 1).cast("string").alias("End")
    ).alias("TimePeriod")
    if coverage:
        body = F.struct(plain_text("used").alias("OnDemandHours"), plain_text("share").alias("CoverageHoursPercentage"))
        total = F.struct(body.alias("CoverageHours")).alias("Total")
    else:
        total = F.struct(plain_text("used").alias("UsedHours"), plain_text("share").alias("UtilizationPercentage")).alias("Total")
    return {
        service: days.where(F.col("event_type") == kind).select(F.array(F.struct(period, total)).alias(member))
        for service, kind in kinds.items()
    }


def account_wide_response(spark: SparkSession, sf_dir: str, member: str) -> DataFrame:
    """One landed response over all events: the series no service divides."""
    period = F.struct(
        F.col("day").cast("string").alias("Start"), F.date_add("day", 1).cast("string").alias("End")
    ).alias("TimePeriod")
    total = F.struct(
        plain_text("used").alias("UsedHours"), plain_text("share").alias("UtilizationPercentage")
    ).alias("Total")
    return event_days(spark, sf_dir, ()).select(F.array(F.struct(period, total)).alias(member))


def day_range(first: str, last: str) -> list[dt.date]:
    start, end = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
    return [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]


_STORED: dict[tuple[str, str], Star] = {}


def stored_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star schema written out once per application, as reports use it."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _STORED:
        directories = account_directories(spark, sf_dir)
        _STORED[known] = load_star(two_sources(spark, sf_dir, GRAIN), directories, shared_work_dir(spark, "star"))
    return _STORED[known]
