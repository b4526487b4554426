"""The SQL each registered query is compared with (DuckDB dialect).

The input CTEs repeat ``inputs.py``; everything after them is written
independently of the library.
"""

from __future__ import annotations

import re

from registry import inputs as I
from tallyfold.functions.fixed_values import PRODUCT_CODE_NAMES

ORACLE: dict[str, str] = {}

# --- inputs ---------------------------------------------------------------


def _duck(text: str) -> str:
    return re.sub(r"(\d+\.\d+)D\b", r"CAST(\1 AS DOUBLE)", re.sub(r"\bship\b", "l_shipdate", text))


def _line_columns() -> str:
    parts = list(I.TIE_BREAK)
    for name, text in I.LINE_SQL.items():
        duck = _duck(text)
        parts.append(f"CAST({duck} AS INTEGER) AS {name}" if name in ("year", "month") else f"{duck} AS {name}")
    parts += [f"'{value}' AS {name}" for name, value in I.CONSTANT_COLUMNS.items()]
    parts += [f"'' AS {name}" for name in I.EMPTY_COLUMNS]
    return ",\n  ".join(parts)


LINES = f"""lines AS (
  SELECT {_line_columns()}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = (l_partkey % 200) % 25)"""

CODES = "codes(code, listed) AS (VALUES " + ", ".join(f"('{c}', '{n}')" for c, n in PRODUCT_CODE_NAMES.items()) + ")"

DIRECTORY = """directory AS (
  SELECT 'A' || n_nationkey AS account_id, n_name AS account_name FROM nation WHERE n_nationkey < 20)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- rules ----------------------------------------------------------------

TYPE = "line_item_line_item_type"
RUNNING = f"{TYPE} IN ('DiscountedUsage', 'SavingsPlanCoveredUsage', 'Usage')"
CATEGORY = f"CASE WHEN {RUNNING} THEN 'Running_Usage' ELSE 'non_usage' END"
KEPT = f"{TYPE} NOT IN ('Refund', 'Credit', 'Tax', 'Fee')"


def _option(reserved: bool = True) -> str:
    middle = "WHEN reservation_reservation_a_r_n <> '' THEN 'Reserved'" if reserved else ""
    return f"""CASE WHEN savings_plan_savings_plan_a_r_n <> '' THEN 'SavingsPlan' {middle}
      WHEN line_item_usage_type LIKE '%Spot%' THEN 'Spot' ELSE 'OnDemand' END"""


def _arn(reserved: bool = True) -> str:
    middle = "WHEN reservation_reservation_a_r_n <> '' THEN reservation_reservation_a_r_n" if reserved else ""
    return f"""CASE WHEN savings_plan_savings_plan_a_r_n <> '' THEN savings_plan_savings_plan_a_r_n
      {middle} ELSE '' END"""


def _fee(reserved: bool) -> str:
    return f"{TYPE} = 'Fee'" + (" AND reservation_reservation_a_r_n <> ''" if reserved else "")


def _amortized(reserved: bool = True, open_month: str | None = None) -> str:
    unused = "reservation_unused_amortized_upfront_fee_for_billing_period + reservation_unused_recurring_fee"
    if open_month:
        unused = f"""CASE WHEN strftime(line_item_usage_start_date, '%Y%m') = '{open_month}'
          THEN reservation_unused_amortized_upfront_fee_for_billing_period ELSE {unused} END"""
    return f"""CASE {TYPE}
      WHEN 'SavingsPlanCoveredUsage' THEN savings_plan_savings_plan_effective_cost
      WHEN 'SavingsPlanRecurringFee' THEN savings_plan_total_commitment_to_date - savings_plan_used_commitment
      WHEN 'SavingsPlanNegation' THEN 0 WHEN 'SavingsPlanUpfrontFee' THEN 0
      WHEN 'DiscountedUsage' THEN reservation_effective_cost
      WHEN 'RIFee' THEN {unused}
      ELSE CASE WHEN {_fee(reserved)} THEN 0 ELSE line_item_unblended_cost END END"""


def _upfront(reserved: bool = True) -> str:
    return f"""CASE WHEN {TYPE} = 'SavingsPlanUpfrontFee' OR ({_fee(reserved)})
      THEN line_item_unblended_cost ELSE 0 END"""


TRUEUP = f"""CASE {TYPE} WHEN 'SavingsPlanRecurringFee' THEN -savings_plan_amortized_upfront_commitment_for_billing_period
      WHEN 'RIFee' THEN -reservation_amortized_upfront_fee_for_billing_period ELSE 0 END"""
PUBLIC = f"CASE WHEN {TYPE} <> 'SavingsPlanNegation' THEN pricing_public_on_demand_cost ELSE 0 END"
QUANTITY = f"CASE WHEN {RUNNING} THEN line_item_usage_amount ELSE 0 END"

SERVICE = f"""CASE WHEN bill_billing_entity = 'AWS Marketplace' AND {TYPE} NOT LIKE '%Discount%' THEN product_product_name
      WHEN product_servicecode = '' THEN line_item_product_code ELSE product_servicecode END"""

RESOLVED = f"""CASE
      WHEN product_servicename = 'AWS Data Transfer' AND line_item_product_code IN (SELECT code FROM codes)
        THEN (SELECT listed FROM codes WHERE code = line_item_product_code)
      WHEN product_servicename <> '' THEN product_servicename
      WHEN line_item_product_code = 'AmazonEC2' THEN 'Amazon Elastic Compute Cloud'
      WHEN line_item_product_code = 'AmazonRedshift' THEN 'Amazon Redshift'
      WHEN line_item_product_code = 'AmazonElastiCache' THEN 'Amazon ElastiCache'
      WHEN line_item_product_code = 'AmazonRDS' THEN 'Amazon Relational Database Service'
      WHEN line_item_product_code = 'OCBElasticComputeCloud' AND {TYPE} = 'Fee' THEN 'OCBElasticComputeCloud'
      WHEN bill_billing_entity = 'AWS Marketplace' THEN 'AWS Marketplace ' || product_product_name
      ELSE product_servicename END"""

SPOT = f"(line_item_usage_type LIKE '%Spot%' AND line_item_product_code = 'AmazonEC2' AND {TYPE} = 'Usage')"
TEXT = "line_item_line_item_description"
FAMILY = f"CASE WHEN {SPOT} THEN split_part({TEXT}, '.', 1) ELSE product_instance_type_family END"
INSTANCE = f"CASE WHEN {SPOT} THEN split_part({TEXT}, ' ', 1) ELSE product_instance_type END"
PLATFORM = f"CASE WHEN {SPOT} THEN split_part(split_part({TEXT}, ' ', 2), '/', 1) ELSE product_operating_system END"

MASKED = f"""(({TYPE} = 'Refund' AND {TEXT} = 'Enterprise Program Discount')
      OR (line_item_usage_type LIKE '%TimedStorage-ByteHrs%' AND product_product_name LIKE '%Amazon Simple Storage Service%')
      OR (line_item_usage_type LIKE '%TimedStorage-GlacierByteHrs%' AND product_product_name LIKE '%Amazon Simple Storage Service%')
      OR (line_item_usage_type LIKE '%-Requests-HTTP-Proxy' AND product_product_name LIKE '%CloudFront%')
      OR (line_item_usage_type LIKE '%-Requests-HTTPS-Proxy' AND product_product_name LIKE '%CloudFront%')
      OR (line_item_usage_type LIKE '%-DataTransfer-Out-Bytes' AND product_product_name LIKE '%CloudFront%')
      OR line_item_usage_type LIKE '%DataTransfer-Regional-Bytes')"""


def _money(expression: str, name: str, how: str = "sum") -> str:
    return f"round({how}({expression}), 4) AS {name}"


DAY_ID = "strftime(line_item_usage_start_date, '%Y%m%d')"

ORACLE["charge_classification"] = f"""{_with(LINES)}
SELECT {TYPE} AS charge_type, {CATEGORY} AS charge_category, {_option()} AS purchase_option,
  {_option(False)} AS purchase_option_second, {_arn()} AS ri_sp_arn, {SERVICE} AS service, count(*) AS lines
FROM lines GROUP BY ALL"""

ORACLE["amortized_cost_by_type"] = f"""{_with(LINES)}
SELECT {TYPE} AS charge_type, {_money(_amortized(), 'amortized_cost')},
  {_money(_amortized(False), 'amortized_cost_second')}
FROM lines GROUP BY ALL"""

ORACLE["amortized_cost_open_month"] = f"""{_with(LINES)}
SELECT year, month, {TYPE} AS charge_type, {_money(_amortized(open_month='200108'), 'amortized_cost')},
  {_money(_amortized(False, open_month='200108'), 'amortized_cost_second')}
FROM lines GROUP BY ALL"""

ORACLE["cost_measures"] = f"""{_with(LINES)}
SELECT {TYPE} AS charge_type, {_money(QUANTITY, 'usage_quantity')},
  {_money('line_item_unblended_cost', 'unblended_cost')}, {_money(TRUEUP, 'ri_sp_trueup')},
  {_money(_upfront(), 'ri_sp_upfront_fees')}, {_money(PUBLIC, 'public_cost')},
  {_money(_upfront(False), 'ri_sp_upfront_fees_second')}
FROM lines GROUP BY ALL"""

ORACLE["service_name_resolution"] = f"""{_with(LINES, CODES)}
SELECT product_servicename, line_item_product_code, bill_billing_entity,
  resolved AS resolved_servicename, count(*) AS lines
FROM (SELECT *, {RESOLVED} AS resolved FROM lines) GROUP BY ALL"""

ORACLE["spot_detail"] = f"""{_with(LINES)}
SELECT line_item_product_code, {FAMILY} AS instance_type_family, {INSTANCE} AS instance_type,
  {PLATFORM} AS platform, count(*) AS lines
FROM lines GROUP BY ALL"""


def _masked_columns() -> str:
    return f"""CASE WHEN {MASKED} THEN 'Masked description' ELSE {TEXT} END AS {TEXT},
  CASE WHEN {MASKED} THEN '0.01' ELSE line_item_unblended_rate END AS line_item_unblended_rate,
  round(CASE WHEN {MASKED} THEN 0.01::DOUBLE ELSE line_item_unblended_cost END, 4) AS line_item_unblended_cost,
  CASE WHEN {MASKED} THEN '0.01' ELSE line_item_blended_rate END AS line_item_blended_rate,
  round(CASE WHEN {MASKED} THEN 0.01::DOUBLE ELSE line_item_blended_cost END, 4) AS line_item_blended_cost"""


TIES = ", ".join(I.TIE_BREAK)

ORACLE["mask_sensitive_costs"] = f"""{_with(LINES)}
SELECT {TIES}, {TYPE}, line_item_usage_type, {_masked_columns()} FROM lines"""

ORACLE["masked_month"] = f"""{_with(LINES)}
SELECT {TIES}, {TYPE}, line_item_usage_type, product_product_name, year, month, {_masked_columns()}
FROM lines WHERE year = 1998 AND month = 4"""

# --- summary and fact -----------------------------------------------------


def _summary(reserved: bool, tags: list[str], where: str = "TRUE", open_month: str | None = None, source: str = "lines") -> str:
    """The rules per line, then one wide GROUP BY with the raw name and tags."""
    raw_tags = ", ".join(f"{t} AS raw_{t}" for t in tags)
    clean_tags = ", ".join(f"coalesce(raw_{t}, '') AS {t}" for t in tags)
    return f"""SELECT * EXCLUDE (raw_name, {', '.join('raw_' + t for t in tags)}), {clean_tags} FROM (
  SELECT year, month, CAST(bill_billing_period_start_date AS DATE) AS billing_period,
    CAST(line_item_usage_start_date AS DATE) AS usage_date, bill_payer_account_id AS payer_account_id,
    line_item_usage_account_id AS linked_account_id, bill_invoice_id AS invoice_id, product_sku,
    {TYPE} AS charge_type, {CATEGORY} AS charge_category, {_option(reserved)} AS purchase_option,
    {_arn(reserved)} AS ri_sp_arn, line_item_product_code AS product_code, product_product_name AS product_name,
    {SERVICE} AS service, product_product_family AS product_family, line_item_usage_type AS usage_type,
    line_item_operation AS operation, {TEXT} AS item_description,
    line_item_availability_zone AS availability_zone, product_region AS region,
    {FAMILY} AS instance_type_family, {INSTANCE} AS instance_type, {PLATFORM} AS platform,
    product_tenancy AS tenancy, product_physical_processor AS processor, product_processor_features AS processor_features,
    product_database_engine AS database_engine, product_group, product_from_location, product_to_location,
    product_current_generation AS current_generation, line_item_legal_entity AS legal_entity,
    bill_billing_entity AS billing_entity, pricing_unit,
    count(DISTINCT line_item_resource_id) AS resource_id_count, {_money(QUANTITY, 'usage_quantity')},
    {_money('line_item_unblended_cost', 'unblended_cost')}, {_money(_amortized(reserved, open_month), 'amortized_cost')},
    {_money(TRUEUP, 'ri_sp_trueup')}, {_money(_upfront(reserved), 'ri_sp_upfront_fees')}, {_money(PUBLIC, 'public_cost')},
    resolved AS product_servicename, product_servicename AS raw_name, {raw_tags},
    line_item_operation, line_item_product_code, product_product_family, product_region, product_servicecode
  FROM (SELECT *, {RESOLVED} AS resolved FROM {source}) WHERE {where} GROUP BY ALL)"""


SECOND = """second AS (SELECT * EXCLUDE (reservation_reservation_a_r_n, resource_tags_user_name),
  'own-' || l_linenumber AS resource_tags_user_owner FROM lines)"""

ORACLE["cost_summary"] = _with(LINES, CODES) + _summary(True, I.TAGS_ONE)
ORACLE["cost_summary_lookback"] = _with(LINES, CODES) + _summary(
    True, I.TAGS_ONE, "bill_billing_period_start_date >= DATE '2001-01-01' AND make_date(year, month, 1) >= DATE '2001-01-01'", "200108"
)
ORACLE["cost_summary_source2"] = _with(LINES, CODES, SECOND) + _summary(False, I.TAGS_TWO, source="second")

ORACLE["exact_resource_count"] = f"""{_with(LINES)}
SELECT line_item_usage_account_id, line_item_product_code, count(DISTINCT line_item_resource_id) AS resource_id_count
FROM lines GROUP BY ALL"""

ORACLE["approx_resource_count"] = f"SELECT *, true AS within FROM ({ORACLE['exact_resource_count']})"

PRODUCT = [
    "line_item_operation", "line_item_product_code", "product_product_family",
    "product_region", "product_servicecode", "product_servicename",
]


def _key(columns: list[str], prefix: str = "") -> str:
    joined = " || '||' || ".join(f"coalesce({prefix}{c}, '')" for c in sorted(columns))
    return f"sha256({joined})"


# Lines with resolved name, clean tags and both keys; ``reserved`` per source.
ALL_TAGS = sorted(set(I.TAGS_ONE) | set(I.TAGS_TWO))


def _keyed(reserved: bool, source: str, tags: list[str], have: list[str]) -> str:
    tag_columns = ", ".join(f"coalesce({t}, '') AS {t}" if t in have else f"'' AS {t}" for t in tags)
    clean_tags = " || '||' || ".join(f"coalesce({t}, '')" if t in have else "''" for t in sorted(tags))
    product = " || '||' || ".join(
        "coalesce(resolved, '')" if c == "product_servicename" else f"coalesce({c}, '')" for c in PRODUCT
    )
    return f"""SELECT line_item_usage_account_id AS aws_account_dim_id, {DAY_ID} AS date_dim_id,
    {TYPE} AS charge_type, {_option(reserved)} AS purchase_option, {CATEGORY} AS charge_category,
    line_item_product_code AS product_code, {_amortized(reserved)} AS amortized, line_item_unblended_cost AS unblended,
    {TRUEUP} AS trueup, {_upfront(reserved)} AS upfront, {PUBLIC} AS public,
    sha256({clean_tags}) AS tag_dim_id, sha256({product}) AS aws_product_dim_id, year, month, {tag_columns},
    line_item_operation, line_item_product_code, coalesce(product_product_family, '') AS product_product_family,
    coalesce(product_region, '') AS product_region, coalesce(product_servicecode, '') AS product_servicecode,
    coalesce(resolved, '') AS product_servicename, bill_payer_account_id, line_item_usage_account_id
  FROM (SELECT *, {RESOLVED} AS resolved FROM {source})"""


def _fact(keyed: str) -> str:
    return f"""SELECT aws_account_dim_id, date_dim_id, charge_type, purchase_option, charge_category, product_code,
  {_money('amortized', 'amortized_cost')}, {_money('unblended', 'unblended_cost')}, {_money('trueup', 'ri_sp_trueup')},
  {_money('upfront', 'ri_sp_upfront_fees')}, {_money('public', 'public_cost')}, tag_dim_id, aws_product_dim_id, year, month
FROM {keyed} GROUP BY aws_account_dim_id, date_dim_id, charge_type, purchase_option, charge_category, product_code,
  tag_dim_id, aws_product_dim_id, year, month"""


ONE = f"one AS ({_keyed(True, 'lines', I.TAGS_ONE, I.TAGS_ONE)})"
FIRST_PART = "first_part AS (SELECT * FROM lines WHERE l_suppkey % 4 <> 3)"
SECOND_PART = "second_part AS (SELECT * FROM second WHERE l_suppkey % 4 = 3)"
TWO_INPUTS = (LINES, CODES, SECOND, FIRST_PART, SECOND_PART)
KEYED_1 = f"keyed_1 AS ({_keyed(True, 'first_part', ALL_TAGS, I.TAGS_ONE)})"
KEYED_2 = f"keyed_2 AS ({_keyed(False, 'second_part', ALL_TAGS, I.TAGS_TWO)})"
BOTH = "both_sources AS (SELECT * FROM keyed_1 UNION ALL SELECT * FROM keyed_2)"
TWO = (*TWO_INPUTS, KEYED_1, KEYED_2)

ORACLE["resource_count_by_month"] = f"""{_with(LINES, SECOND, FIRST_PART, SECOND_PART)}
SELECT year, month, line_item_usage_account_id AS linked_account_id, count(DISTINCT line_item_resource_id) AS resource_id_count,
  true AS within
FROM (SELECT year, month, line_item_usage_account_id, line_item_resource_id FROM first_part
  UNION ALL SELECT year, month, line_item_usage_account_id, line_item_resource_id FROM second_part) GROUP BY ALL"""
ORACLE["cost_fact_one_source"] = _with(LINES, CODES, ONE) + _fact("one")
_start = "date_trunc('month', line_item_usage_start_date)::TIMESTAMP"
_hours = "to_hours((l_orderkey % 24 + 336 * (day(line_item_usage_start_date) % 2))::BIGINT)"
COARSE = (
    LINES.replace("lines AS (", "fine AS (", 1),
    "lines AS (SELECT * REPLACE ("
    + ", ".join(f"{text} AS {name}" for name, text in {**I.COARSE_SQL, "line_item_usage_start_date": f"{_start} + {_hours}"}.items())
    + ") FROM fine)",
)
ORACLE["cost_summary_coarse"] = _with(*COARSE, CODES) + _summary(True, I.TAGS_ONE)
ORACLE["cost_fact_coarse"] = _with(*COARSE, CODES, ONE) + _fact("one")
ORACLE["cost_fact_from_summary"] = ORACLE["cost_fact_one_source"]
ORACLE["cost_fact_two_sources"] = _with(*TWO) + _fact("keyed_1") + "\nUNION ALL\n" + _fact("keyed_2")
ORACLE["cost_fact_month"] = f"""SELECT * FROM ({ORACLE["cost_fact_two_sources"]}) WHERE year = 1998 AND month = 4"""


def _transfer(plus: int = 0) -> str:
    return f"""SELECT coalesce(max(listed), '') AS product_servicename, line_item_product_code,
  line_item_usage_account_id AS linked_account_id, {DAY_ID} AS date_dim_id, year, month,
  round(sum(CASE WHEN product_servicename = 'AWS Data Transfer' AND code IS NOT NULL THEN {_amortized()} ELSE 0 END) + {plus}, 4)
    AS "DT_cost"
FROM lines LEFT JOIN codes ON code = line_item_product_code
GROUP BY line_item_product_code, line_item_usage_account_id, {DAY_ID}, year, month"""


ORACLE["data_transfer"] = _with(LINES, CODES) + _transfer()

# --- dimensions -----------------------------------------------------------


def _tags(source: str, tags: list[str], where: str = "TRUE") -> str:
    columns = ", ".join(f"coalesce({t}, '') AS {t}" for t in tags)
    return f"SELECT *, {_key(tags)} AS tag_dim_id FROM (SELECT DISTINCT {columns} FROM {source} WHERE {where})"


ORACLE["tag_dim"] = _with(LINES) + _tags("lines", I.TAGS_ONE)
ORACLE["tag_dim_month"] = _with(LINES) + _tags("lines", I.TAGS_ONE, "year = 1998 AND month = 4")
ORACLE["tag_dim_delta"] = f"""{_with(LINES)}{_tags('lines', I.TAGS_ONE)}
EXCEPT {_tags('lines', I.TAGS_ONE, "line_item_usage_start_date < TIMESTAMP '1995-01-08'")}"""
TAG_DIM_TWO = f"SELECT DISTINCT {', '.join(ALL_TAGS)}, tag_dim_id FROM both_sources"
ORACLE["tag_dim_two_sources"] = _with(*TWO, BOTH) + TAG_DIM_TWO


def _products(source: str, where: str = "TRUE") -> str:
    return f"SELECT DISTINCT {', '.join(PRODUCT)}, aws_product_dim_id FROM {source} WHERE {where}"


ORACLE["product_dim"] = _with(*TWO, BOTH) + _products("both_sources")
ORACLE["product_dim_month"] = _with(LINES, CODES, ONE) + _products("one", "year = 1998 AND month = 4")
ORACLE["product_dim_delta"] = f"""{_with(LINES, CODES, ONE)}{_products('one')}
EXCEPT {_products('one', "date_dim_id < '20010101'")}"""


def _accounts(where: str = "TRUE") -> str:
    return f"""SELECT DISTINCT bill_payer_account_id, line_item_usage_account_id,
  line_item_usage_account_id AS aws_account_dim_id, coalesce(account_name, '') AS account_name
FROM lines LEFT JOIN directory ON account_id = line_item_usage_account_id WHERE {where}"""


ORACLE["account_dimension"] = _with(LINES, DIRECTORY) + _accounts()
ORACLE["account_dim_month"] = _with(LINES, DIRECTORY) + _accounts("year = 1998 AND month = 4")
ORACLE["account_dim_delta"] = _with(LINES, DIRECTORY) + _accounts(
    """line_item_usage_account_id NOT IN
  (SELECT line_item_usage_account_id FROM lines WHERE line_item_usage_start_date < TIMESTAMP '1995-01-03')"""
)
ORACLE["replace_table"] = ORACLE["account_dimension"]
ORACLE["swap_table"] = ORACLE["tag_dim"]

DATES = """strftime(d, '%Y%m%d') AS date_dim_id, strftime(d, '%d') AS day_attr, strftime(d, '%m') AS month_attr,
  strftime(d, '%Y') AS year_attr"""
SPAN = "(SELECT min(l_shipdate)::DATE AS a, max(l_shipdate)::DATE AS b FROM lineitem)"
ALL_DATES = f"SELECT {DATES} FROM (SELECT unnest(generate_series(a::TIMESTAMP, (b + 1)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM {SPAN})"
ORACLE["date_dimension"] = ALL_DATES
ORACLE["date_dim_today"] = f"SELECT count(*) + 1 AS days, true AS has_today FROM ({ALL_DATES})"
ORACLE["tag_dim_by_part_of_name"] = ORACLE["tag_dim"]
ORACLE["date_dim_daily"] = f"{ALL_DATES} UNION SELECT {DATES} FROM (SELECT DATE '2002-02-03' AS d)"

# --- latest rows ----------------------------------------------------------

BRIDGE = f"""bridge AS (
  SELECT regexp_replace(coalesce(line_item_resource_id, ''), '^.*[/:]', '') AS line_item_resource_id,
    line_item_usage_start_date, line_item_usage_account_id, {_key(I.TAGS_ONE)} AS tag_dim_id, year AS billed_year, month AS billed_month
  FROM (SELECT *, row_number() OVER (PARTITION BY line_item_resource_id
      ORDER BY line_item_usage_start_date DESC, {TIES}) AS rn FROM lines) WHERE rn = 1)"""
BRIDGE_ROWS = """SELECT line_item_resource_id, line_item_usage_start_date::DATE AS line_item_usage_start_date,
  line_item_usage_account_id, tag_dim_id, year(line_item_usage_start_date)::INTEGER AS year,
  month(line_item_usage_start_date)::INTEGER AS month, day(line_item_usage_start_date)::INTEGER AS day FROM bridge"""
ORACLE["latest_tags_per_resource"] = _with(LINES, BRIDGE) + BRIDGE_ROWS
ORACLE["latest_tags_in_month"] = _with(LINES, BRIDGE) + BRIDGE_ROWS + " WHERE billed_year = 2001 AND billed_month = 10"

ORACLE["tag_bridge_incremental"] = ORACLE["latest_tags_per_resource"]
ORACLE["changed_months_only"] = f"""{_with(LINES.replace("lines AS (", "sent AS (", 1),
  "lines AS (SELECT * FROM sent WHERE NOT (year = 1998 AND month = 4 AND l_linenumber > 3))", CODES, ONE)}
SELECT *, '1998-4' AS done_again FROM ({_fact("one")})"""


def _tag_map(account: str | None = None) -> str:
    where = f"WHERE line_item_usage_account_id = '{account}'" if account else ""
    return f"""tag_map AS (SELECT line_item_resource_id, line_item_usage_account_id, tag_dim_id FROM (
  SELECT *, row_number() OVER (PARTITION BY line_item_resource_id
    ORDER BY line_item_usage_start_date DESC, line_item_usage_account_id, tag_dim_id) AS rn FROM bridge {where}) WHERE rn = 1)"""


ORACLE["current_tags"] = _with(LINES, BRIDGE, _tag_map()) + "SELECT * FROM tag_map"

# --- usage ----------------------------------------------------------------

# Namespace, dimension key and metric names per service.
SERVICES = {
    "ec2": ("AWSEC2", "InstanceId", ["CPUUtilization", "NetworkIn", "NetworkOut"]),
    "rds": ("AWSRDS", "DBInstanceIdentifier", ["CPUUtilization", "DatabaseConnections", "NetworkReceiveThroughput"]),
    "elasticache": ("AWSElastiCache", "CacheClusterId", ["EngineCPUUtilization", "DatabaseMemoryUsagePercentage", "CurrConnections"]),
    "alb": ("AWSApplicationELB", "LoadBalancer", ["HealthyHostCount", "RequestCount", "ConsumedLCUs"]),
    "elb": ("ELB", "LoadBalancerName", ["ConsumedLCUs", "PreWarmedLCUs"]),
    "s3": ("AWSS3", "BucketName", ["GetRequests", "PutRequests"]),
    "ebs": ("AWSEBS", "VolumeId", ["VolumeReadBytes", "VolumeWriteBytes"]),
}


def _metrics(service: str) -> str:
    namespace, key, names = SERVICES[service]
    cases = " ".join(f"WHEN '{k}' THEN '{n}'" for k, n in zip(("click", "view", "purchase"), names))
    prefix = "app/lb/i-" if service == "alb" else "i-"
    return f"""metrics AS (
  SELECT 'stream' AS metric_stream_name, 'A' || user_id % 20 AS account_id, 'region-1' AS region,
    '{namespace}' AS namespace, CASE event_type {cases} ELSE event_type END AS metric_name,
    '{{"{key}":"{prefix}' || user_id % 20 || '"}}' AS dimensions, epoch_us(ts) // 1000 AS timestamp,
    value * 0.5::DOUBLE AS value_min, value * 1.5::DOUBLE AS value_max, value * (1 + event_id % 3) AS value_sum,
    (event_id % 5)::DOUBLE AS value_count, 'Percent' AS unit,
    year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day, hour(ts)::INTEGER AS hour
  FROM events)"""


def _per_metric(metric: str, columns: str) -> str:
    return f"""(SELECT resource, account_id, metric_date, {columns} FROM records
      WHERE metric_name = '{metric}' GROUP BY ALL)"""


def _usage_columns(service: str, columns: dict[str, str], hourly: str = "", account: str | None = None, where: str = "TRUE") -> str:
    """One aggregate per metric, inner-joined, then the tag map."""
    _, key, _ = SERVICES[service]
    mean = "value_sum / nullif(value_count, 0)"
    resource = f"json_extract_string(dimensions, '$.{key}')"
    records = f"""records AS (SELECT regexp_replace({resource}, '^.*[/:]', '') AS resource, account_id, metric_name, hour,
    make_date(year, month, day) AS metric_date, value_max, value_sum, {mean} AS mean FROM metrics WHERE {where})"""
    joins = " JOIN ".join(
        _per_metric(m, c) + f" m{i}" + (" USING (resource, account_id, metric_date)" if i else "")
        for i, (m, c) in enumerate(columns.items())
    )
    return (
        _with(LINES, BRIDGE, _tag_map(account), _metrics(service), records)
        + f"""SELECT * EXCLUDE (account_id, metric_date, line_item_resource_id, line_item_usage_account_id),
  account_id AS aws_account_dim_id, strftime(metric_date, '%Y%m%d') AS date_dim_id, year(metric_date)::INTEGER AS year,
  month(metric_date)::INTEGER AS month, day(metric_date)::INTEGER AS day
FROM {joins} {hourly} JOIN tag_map ON resource = line_item_resource_id AND account_id = line_item_usage_account_id"""
    )


def _agg(how: str, column: str, name: str) -> str:
    return f"round({how}({column}), 8) AS {name}"


def _percentile(p: float, name: str) -> str:
    return f"round(quantile_cont(mean, {p}), 8) AS {name}"


HOURLY = """JOIN (SELECT resource, account_id, metric_date, round(max(p), 8) AS max_p99 FROM (
    SELECT resource, account_id, metric_date, hour, quantile_cont(mean, 0.99) AS p FROM records
    WHERE metric_name = 'CPUUtilization' GROUP BY ALL) GROUP BY ALL) h USING (resource, account_id, metric_date)"""
EC2_CPU = [_percentile(0.95, "p95_cpu"), _percentile(0.99, "p99_cpu"), _agg("avg", "mean", "avg_cpu")]
EC2_NETWORK = {"NetworkIn": _agg("sum", "value_sum", "network_in"), "NetworkOut": _agg("sum", "value_sum", "network_out")}

ORACLE["usage_ec2"] = _usage_columns(
    "ec2",
    {"CPUUtilization": ", ".join([*EC2_CPU, _percentile(0.9, "p90_cpu"), _percentile(0.5, "p50_cpu")]), **EC2_NETWORK},
    HOURLY,
)
ORACLE["usage_ec2_hot_groups"] = ORACLE["usage_ec2"]
ORACLE["usage_variant_ec2_backfill"] = _usage_columns("ec2", {"CPUUtilization": ", ".join(EC2_CPU), **EC2_NETWORK})
RDS_CPU = _agg("max", "value_sum", "max_cpu") + ", " + _agg("avg", "value_sum", "avg_cpu")


def _rds(connections: str) -> dict[str, str]:
    return {
        "CPUUtilization": RDS_CPU,
        "DatabaseConnections": _agg(connections, "value_sum", "database_connections"),
        "NetworkReceiveThroughput": _agg("sum", "value_sum", "network_receive_throughput"),
    }


ORACLE["usage_rds"] = _usage_columns("rds", _rds("sum"))
ORACLE["usage_variant_max"] = _usage_columns("rds", _rds("max"))
ORACLE["usage_one_account"] = _usage_columns("rds", _rds("max"), account="A7")
ORACLE["usage_elasticache"] = _usage_columns(
    "elasticache",
    {
        "EngineCPUUtilization": RDS_CPU,
        "DatabaseMemoryUsagePercentage": _agg("avg", "value_sum", "database_memory_usage_percentage"),
        "CurrConnections": _agg("sum", "value_sum", "curr_connections"),
    },
)


def _alb(how: str, column: str) -> dict[str, str]:
    names = {"HealthyHostCount": "healthy_host_count", "RequestCount": "request_count", "ConsumedLCUs": "consumed_lcus"}
    return {metric: _agg(how, column, name) for metric, name in names.items()}


ORACLE["usage_alb"] = _usage_columns("alb", _alb("max", "value_max"))
ORACLE["usage_variant_alb_sum"] = _usage_columns("alb", _alb("sum", "value_sum"))


def _sums(**names: str) -> dict[str, str]:
    return {metric: _agg("sum", "value_sum", name) for metric, name in names.items()}


S3_SUMS = _sums(GetRequests="get_requests", PutRequests="put_requests")
ORACLE["usage_elb"] = _usage_columns("elb", _sums(ConsumedLCUs="consumed_lcus", PreWarmedLCUs="pre_warmed_lcus"))
ORACLE["usage_s3"] = _usage_columns("s3", S3_SUMS)
ORACLE["usage_ebs"] = _usage_columns("ebs", _sums(VolumeReadBytes="volume_read_bytes", VolumeWriteBytes="volume_write_bytes"))
ORACLE["usage_variant_sums_as_max"] = _usage_columns(
    "ebs",
    {
        "VolumeReadBytes": _agg("max", "value_sum", "volume_read_bytes"),
        "VolumeWriteBytes": _agg("max", "value_sum", "volume_write_bytes"),
    },
)
ORACLE["metric_backfill"] = _usage_columns("s3", S3_SUMS, where="year = 2024 AND month = 1 AND day BETWEEN 1 AND 28")
ORACLE["usage_refresh_stream"] = ORACLE["usage_s3"]

ORACLE["percentiles_of_costs"] = f"""{_with(LINES)}
SELECT {TYPE}, round(quantile_cont(line_item_unblended_cost, 0.5), 6) AS p50,
  round(quantile_cont(line_item_unblended_cost, 0.9), 6) AS p90,
  round(quantile_cont(line_item_unblended_cost, 0.99), 6) AS p99
FROM lines GROUP BY ALL"""

ORACLE["percentiles_with_null_keys"] = f"""{_with(LINES)}
SELECT resource_tags_user_component, round(quantile_cont(line_item_unblended_cost, 0.5), 6) AS p50,
  round(quantile_cont(line_item_unblended_cost, 0.9), 6) AS p90 FROM lines GROUP BY ALL"""

METRIC_ROWS = """SELECT * REPLACE (round(value_min, 6) AS value_min, round(value_max, 6) AS value_max,
  round(value_sum, 6) AS value_sum, round(value_count, 6) AS value_count) FROM metrics"""
for _name in ("metric_ingest", "metric_ingest_stream", "metric_json_scan"):
    ORACLE[_name] = _with(_metrics("ec2")) + METRIC_ROWS
ORACLE["metric_stream_then_backfill"] = ORACLE["metric_ingest"]
ORACLE["metric_replay_overlap"] = ORACLE["metric_ingest"]
ORACLE["metric_stream_misfits"] = f"""SELECT * REPLACE (
  CASE WHEN account_id = 'A3' THEN NULL ELSE value_sum END AS value_sum,
  CASE WHEN account_id = 'A5' THEN NULL ELSE "timestamp" END AS "timestamp",
  CASE WHEN account_id = 'A5' THEN NULL ELSE year END AS year, CASE WHEN account_id = 'A5' THEN NULL ELSE month END AS month,
  CASE WHEN account_id = 'A5' THEN NULL ELSE day END AS day, CASE WHEN account_id = 'A5' THEN NULL ELSE hour END AS hour),
  CASE WHEN account_id = 'A3' THEN 'n/a' END AS sent_sum, CASE WHEN account_id = 'A5' THEN 'n/a' END AS sent_timestamp,
  count(*) OVER () AS records, count(*) FILTER (account_id IN ('A3', 'A5')) OVER () AS quarantined
FROM ({ORACLE["metric_ingest"]})"""
ORACLE["metric_ingest_mixed_types"] = f"""SELECT * EXCLUDE (unit)
  REPLACE (CASE WHEN account_id <> 'A3' THEN value_sum END AS value_sum),
  CASE WHEN account_id = 'A3' THEN 'n/a' END AS misfit FROM ({ORACLE["metric_ingest"]})"""
ORACLE["metrics_of_one_day"] = _with(_metrics("ec2")) + METRIC_ROWS + " WHERE year = 2024 AND month = 1 AND day = 9"

# --- writes ---------------------------------------------------------------

ORACLE["upsert_usage"] = f"""WITH usage AS ({ORACLE["usage_s3"]}),
stage AS (SELECT * REPLACE (get_requests * 2 AS get_requests, put_requests * 2 AS put_requests) FROM usage WHERE day >= 15)
SELECT * FROM usage u WHERE day <= 20 AND NOT EXISTS (SELECT 1 FROM stage s WHERE s.date_dim_id = u.date_dim_id
  AND s.aws_account_dim_id = u.aws_account_dim_id AND s.resource = u.resource AND s.tag_dim_id = u.tag_dim_id)
UNION ALL SELECT * FROM stage"""
ORACLE["upsert_usage_table"] = ORACLE["upsert_usage"]

ORACLE["upsert_transfer"] = f"""{_with(LINES, CODES, f"rows AS ({_transfer()})", f"raised AS ({_transfer(1)})")}
SELECT * FROM rows WHERE year < 2000 UNION ALL SELECT * FROM raised WHERE year >= 2000"""

ORACLE["upsert_cost_fact"] = f"""WITH fact AS ({ORACLE["cost_fact_one_source"]})
SELECT * REPLACE (round(CASE WHEN year >= 2000 THEN amortized_cost + 1 ELSE amortized_cost END, 4) AS amortized_cost) FROM fact"""

ORACLE["cost_fact_load"] = ORACLE["upsert_cost_fact"]
ORACLE["partition_overwrite"] = f"""WITH fact AS ({ORACLE["cost_fact_one_source"]})
SELECT * REPLACE (CASE WHEN year = 1998 AND month = 4 THEN 0 ELSE public_cost END AS public_cost) FROM fact"""

ORACLE["overwrite_with_empty_day"] = f"""WITH fact AS ({ORACLE["cost_fact_one_source"]})
SELECT * FROM fact WHERE NOT (year = 1998 AND month = 5)"""

ORACLE["merged_schema_scan"] = f"""{_with(LINES, SECOND, FIRST_PART, SECOND_PART)}
SELECT {TIES}, resource_tags_user_component, resource_tags_user_name, resource_tags_user_squad,
  NULL::VARCHAR AS resource_tags_user_owner FROM first_part
UNION ALL SELECT {TIES}, resource_tags_user_component, NULL, resource_tags_user_squad, resource_tags_user_owner FROM second_part"""

ORACLE["row_counts"] = """SELECT frame, count(*) AS rows FROM (
  SELECT CASE WHEN l_suppkey % 4 = 3 THEN 'second' ELSE 'first' END AS frame FROM lineitem
  UNION ALL SELECT 'both' FROM lineitem) GROUP BY frame"""

# --- reshaping and commitments --------------------------------------------

ORACLE["declared_mapping"] = """SELECT event_id::VARCHAR AS id, try_cast(event_type AS BIGINT) AS number,
  trunc(value)::BIGINT AS whole, props FROM events"""

ORACLE["mixed_type_choice"] = """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN user_id END AS choice_long,
  CASE WHEN event_id % 3 = 1 THEN user_id + 0.5::DOUBLE END AS choice_double,
  CASE WHEN event_id % 3 = 2 THEN event_type END AS choice_string FROM events"""

KINDS = "kinds(kind, service_name) AS (VALUES ('click', 'AMAZON EC2'), ('view', 'AMAZON RDS'), ('purchase', 'AMAZON REDSHIFT'), ('error', 'AMAZON ELASTICACHE'))"
EVENT_DAYS = """days AS (SELECT strftime(ts, '%Y%m%d') AS date_dim_id, event_type, round(sum(value), 2)::VARCHAR AS used,
  round(avg(value), 2)::VARCHAR AS share FROM events GROUP BY ALL)"""


def _commitments(first: str, second: str, source: str = "days JOIN kinds ON kind = event_type") -> str:
    service = "service_name, " if "kinds" in source else ""
    return f"SELECT {service}date_dim_id, used AS {first}, share AS {second} FROM {source}"


ORACLE["commitments_ri_utilization"] = _with(KINDS, EVENT_DAYS) + _commitments('"UsedHours"', '"UtilizationPercentage"')
ORACLE["flatten_commitments"] = ORACLE["commitments_ri_utilization"]
ORACLE["commitments_ri_coverage"] = _with(KINDS, EVENT_DAYS) + _commitments(
    '"CoverageHours_OnDemandHours"', '"CoverageHours_CoverageHoursPercentage"'
)
ORACLE["commitments_of_a_day"] = f"SELECT * FROM ({ORACLE['commitments_ri_coverage']}) WHERE date_dim_id = '20240115'"
ORACLE["commitments_savings_coverage"] = _with(KINDS, EVENT_DAYS) + _commitments(
    '"Total_CoverageHours_OnDemandHours"', '"Total_CoverageHours_CoverageHoursPercentage"'
)
ORACLE["commitments_savings_utilization"] = """SELECT strftime(ts, '%Y%m%d') AS date_dim_id,
  round(sum(value), 2)::VARCHAR AS "Total_UsedHours", round(avg(value), 2)::VARCHAR AS "Total_UtilizationPercentage"
FROM events GROUP BY ALL"""
for _name, _changed in (
    ("ri_utilization", "UsedHours"),
    ("ri_coverage", "CoverageHours_OnDemandHours"),
    ("savings_coverage", "Total_CoverageHours_OnDemandHours"),
    ("savings_utilization", "Total_UsedHours"),
):
    ORACLE[f"commitments_load_{_name}"] = f"""WITH series AS ({ORACLE[f"commitments_{_name}"]})
SELECT * REPLACE (CASE WHEN date_dim_id >= '20240115' THEN '0' ELSE "{_changed}" END AS "{_changed}") FROM series"""
ORACLE["commitments_upsert"] = f"""WITH series AS ({ORACLE["commitments_ri_utilization"]})
SELECT * REPLACE (CASE WHEN date_dim_id >= '20240115' THEN '0' ELSE "UsedHours" END AS "UsedHours") FROM series"""

# --- reports --------------------------------------------------------------

# Fact at its full grain and all four dimensions, as tables.
STAR = (
    *TWO,
    BOTH,
    DIRECTORY,
    f"""fact AS (SELECT aws_account_dim_id, date_dim_id, charge_type, purchase_option, charge_category, product_code,
  tag_dim_id, aws_product_dim_id, year, month, sum(amortized) AS amortized_cost FROM both_sources
  GROUP BY ALL)""",
    f"account_dim AS ({_accounts()})",
    f"tag_dim AS ({TAG_DIM_TWO})",
    f"resource_dim AS ({_products('both_sources')})",
    f"date_dim AS ({ALL_DATES})",
)
COST = "round(sum(f.amortized_cost), 4) AS amortized_cost"
JOIN_A = "JOIN account_dim a ON f.aws_account_dim_id = a.aws_account_dim_id"
JOIN_D = "JOIN date_dim d ON f.date_dim_id = d.date_dim_id"
JOIN_T = "JOIN tag_dim t ON f.tag_dim_id = t.tag_dim_id"
JOIN_P = "JOIN resource_dim p ON f.aws_product_dim_id = p.aws_product_dim_id"
AMORTIZED = "f.charge_type NOT IN ('Refund', 'Credit', 'Tax', 'Fee')"
RDS = "Amazon Relational Database Service"
HALF = "f.date_dim_id BETWEEN '19980401' AND '19980415'"
TWENTY = "f.date_dim_id BETWEEN '19980501' AND '19980520'"


def _report(name: str, columns: str, joins: str, where: str) -> None:
    selected = f"{columns}, {COST}" if columns else COST
    group = "GROUP BY ALL" if columns else ""
    ORACLE[name] = f"{_with(*STAR)}SELECT {selected} FROM fact f {joins} WHERE {where} {group}"


ORACLE["star_load"] = _with(*STAR) + " UNION ALL ".join(
    f"SELECT '{frame}' AS frame, count(*) AS rows FROM {source}"
    for frame, source in (("date", "date_dim"), ("account", "account_dim"), ("tag", "tag_dim"), ("product", "resource_dim"))
) + f" UNION ALL SELECT 'fact', count(*) FROM ({_fact('keyed_1')} UNION ALL {_fact('keyed_2')})"

def _star_of_month(year: int, month: int) -> str:
    only = f" AND year = {year} AND month = {month}"
    tags = ", ".join(ALL_TAGS)
    rows = "SELECT count(*) FROM (SELECT DISTINCT {} FROM both_sources)"
    counts = {
        "account": rows.format("bill_payer_account_id, line_item_usage_account_id"),
        "tag": rows.format(tags),
        "product": rows.format("aws_product_dim_id"),
        "date": "SELECT datediff('day', strptime(min(date_dim_id), '%Y%m%d'), strptime(max(date_dim_id), '%Y%m%d')) + 2 FROM both_sources",
        "fact": f"SELECT count(*) FROM ({_fact('keyed_1')} UNION ALL {_fact('keyed_2')})",
    }
    ctes = _with(LINES, CODES, SECOND, FIRST_PART[:-1] + only + ")", SECOND_PART[:-1] + only + ")", KEYED_1, KEYED_2, BOTH)
    return ctes + " UNION ALL ".join(f"SELECT '{name}' AS frame, ({sql}) AS rows" for name, sql in counts.items())


ORACLE["star_load_month"] = _star_of_month(1998, 4)

SERVICE_DAY = "a.account_name, f.date_dim_id, p.product_servicename"
_report("report_r01", "a.account_name", JOIN_A, AMORTIZED)
ORACLE["report_r01_from_lines"] = ORACLE["report_r01"]
_report("report_r02", SERVICE_DAY, f"{JOIN_A} {JOIN_P}", f"{AMORTIZED} AND p.product_servicename = 'Amazon ElastiCache' AND a.account_name = 'NATION_18' AND {HALF}")
_report("report_r03", SERVICE_DAY, f"{JOIN_A} {JOIN_P}", f"{AMORTIZED} AND p.product_servicename = 'Amazon ElastiCache' AND a.account_name = 'NATION_18' AND f.date_dim_id LIKE '199804%'")
_report("report_r04", "f.date_dim_id, t.resource_tags_user_squad", f"{JOIN_D} {JOIN_A} {JOIN_T}", f"{AMORTIZED} AND d.month_attr = '04' AND d.year_attr = '1998' AND f.aws_account_dim_id = 'A3' AND t.resource_tags_user_squad = 'BUILDING'")
_report("report_r04_all_values", "f.date_dim_id, t.resource_tags_user_component", f"{JOIN_D} {JOIN_A} {JOIN_T}", f"{AMORTIZED} AND d.month_attr = '04' AND d.year_attr = '1998' AND f.aws_account_dim_id = 'A3'")
MONTH_SERVICE = "d.year_attr, d.month_attr, p.product_servicename"
FOUR = f"{JOIN_D} {JOIN_A} {JOIN_T} {JOIN_P}"
_report("report_r05", MONTH_SERVICE, FOUR, f"p.product_servicename = '{RDS}'")
_report("report_r05_without_tax", MONTH_SERVICE, FOUR, f"f.charge_type NOT IN ('Tax') AND p.product_servicename = '{RDS}' AND d.year_attr = '1998' AND d.month_attr = '03'")
_report("report_r06", "a.account_name, f.date_dim_id", JOIN_A, f"{AMORTIZED} AND {HALF} AND f.aws_account_dim_id = 'A3'")
_report("report_r06_named", "a.account_name, f.date_dim_id", f"{JOIN_A} {JOIN_P}", f"{AMORTIZED} AND {TWENTY} AND a.account_name = 'NATION_3'")
_report("report_r07", "a.account_name, p.product_servicename", f"{JOIN_A} {JOIN_P}", f"{AMORTIZED} AND p.product_servicename = 'Amazon ElastiCache' AND a.account_name = 'NATION_18' AND {HALF}")
_report("report_r08_days", "a.account_name", f"{JOIN_A} {JOIN_P}", f"{AMORTIZED} AND a.account_name = 'NATION_3' AND {HALF}")
_report("report_r08_month", "a.account_name", f"{JOIN_A} {JOIN_P}", f"{AMORTIZED} AND a.account_name = 'NATION_3' AND f.date_dim_id LIKE '199804%'")
_report("report_r08_all", "a.account_name, a.aws_account_dim_id", FOUR, f"{AMORTIZED} AND f.date_dim_id LIKE '199805%'")
SERVICE_CHARGE = "p.product_servicename, f.charge_type"
_report("report_r09", SERVICE_CHARGE, f"{JOIN_A} {JOIN_P}", "a.account_name = 'NATION_3' AND f.date_dim_id LIKE '1998%' AND p.product_servicename LIKE 'AWS Marketplace%'")
_report("report_r09_daily", "f.date_dim_id, p.product_servicename, f.charge_type", f"{JOIN_A} {JOIN_P}", "p.product_servicename LIKE 'AWS Mar%' AND f.aws_account_dim_id = 'A3'")
_report("report_r10", SERVICE_CHARGE, f"{JOIN_A} {JOIN_P}", "a.account_name = 'NATION_3' AND f.date_dim_id LIKE '1998%' AND p.product_servicename LIKE 'AWS Marketplace%' OR p.product_servicename LIKE 'OCB%'")
APRIL = "d.month_attr = '04' AND d.year_attr = '1998' AND f.aws_account_dim_id = 'A3' AND f.date_dim_id LIKE '199804%'"
_report("report_r11", "f.purchase_option", FOUR, f"f.charge_type NOT IN ('Refund', 'Credit', 'Tax') AND {APRIL} AND p.product_servicename != '{RDS}'")
_report("report_r12", "", FOUR, f"{AMORTIZED} AND {APRIL} AND f.purchase_option = 'OnDemand'")
MAY = f"{AMORTIZED} AND d.month_attr = '05' AND d.year_attr = '1998' AND f.aws_account_dim_id = 'A3' AND {TWENTY}"
THREE = f"{JOIN_D} {JOIN_A} {JOIN_T}"
_report("report_r13_squad", "", THREE, f"{MAY} AND t.resource_tags_user_squad = 'BUILDING'")
_report("report_r13_payer", "", THREE, f"{MAY} AND a.bill_payer_account_id = 'P3'")
_report("report_r13_payer_daily", "f.date_dim_id", THREE, f"{MAY} AND a.bill_payer_account_id = 'P3'")

ORACLE["report_r14"] = f"""WITH series AS ({ORACLE["commitments_savings_coverage"]})
SELECT round(avg("Total_CoverageHours_CoverageHoursPercentage"::DOUBLE), 6) AS average_coverage
FROM series WHERE date_dim_id LIKE '202401%'"""

ORACLE["report_r15"] = f"""SELECT * FROM ({ORACLE["usage_rds"]}) WHERE resource = 'i-7' AND date_dim_id LIKE '202401%'"""

ORACLE["report_r16"] = """SELECT 'user-' || user_id AS username, 'warehouse' AS database, event_type AS query,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS start_time, strftime(ts + INTERVAL 5 MINUTES, '%Y-%m-%d %H:%M:%S') AS end_time,
  CASE event_type WHEN 'error' THEN 'YES' ELSE 'NO' END AS aborted
FROM events WHERE ts < TIMESTAMP '2024-01-15 06:00:00' AND ts > TIMESTAMP '2024-01-15 00:00:00'"""

LINE_COST = _money(_amortized(), "amortized_cost")
LINE_HALF = f"year = 1998 AND month = 4 AND {DAY_ID} BETWEEN '19980401' AND '19980415'"


def _line_report(name: str, columns: str, where: str, extra: str = "") -> None:
    ORACLE[name] = f"{_with(LINES)}SELECT {columns}, {LINE_COST}{extra} FROM lines WHERE {where} GROUP BY ALL"


RDS_LINE = f"(product_servicename = '{RDS}' OR (product_servicename = '' AND line_item_product_code = 'AmazonRDS'))"
_line_report("report_r17", f"line_item_usage_account_id, {DAY_ID} AS date_dim_id", f"{KEPT} AND {LINE_HALF} AND product_servicename != ''")
_line_report("report_r18", f"{DAY_ID} AS date_dim_id", f"{KEPT} AND {LINE_HALF} AND {RDS_LINE}")
_line_report(
    "report_r19",
    f"{DAY_ID} AS date_dim_id, line_item_usage_type, line_item_operation",
    f"{KEPT} AND year = 1998 AND line_item_usage_account_id = 'A3' AND line_item_product_code = 'AmazonRDS'",
    f", {_money('reservation_effective_cost', 'reservation_cost')}",
)
_line_report("report_r20_service", "product_servicename", f"{KEPT} AND line_item_usage_account_id = 'A3'")
_line_report("report_r20_code", "product_servicename, line_item_product_code", f"{KEPT} AND product_servicename = 'AWS Data Transfer'")
_line_report("report_r20_tags", "resource_tags_user_squad, resource_tags_user_component", f"{KEPT} AND line_item_usage_account_id = 'A3' AND year = 1998")

ORACLE["report_r21"] = f"""{_with(LINES)}SELECT DISTINCT line_item_operation FROM lines
WHERE resource_tags_user_component = '' AND line_item_usage_account_id = 'A3' ORDER BY 1 LIMIT 10"""
ORACLE["report_r21_never_equal"] = f"""{_with(LINES)}SELECT DISTINCT line_item_usage_type FROM lines
WHERE resource_tags_user_component = '' OR resource_tags_user_component = NULL"""
ORACLE["report_r22_marketplace"] = f"""{_with(LINES)}
SELECT line_item_usage_account_id, product_servicename, line_item_product_code, bill_billing_entity,
  line_item_usage_start_date::DATE AS line_item_usage_start_date, round(line_item_blended_cost, 4) AS line_item_blended_cost
FROM lines WHERE bill_billing_entity = 'AWS Marketplace' AND product_servicename = ''"""
ORACLE["report_r22_ids"] = f"""{_with(LINES)}
SELECT identity_line_item_id, line_item_usage_account_id, line_item_unblended_cost FROM lines
WHERE identity_line_item_id = '5979-6-1616-79' OR identity_line_item_id = '7124-7-756-22' OR identity_line_item_id = '11631-5-1148-98'"""
ORACLE["report_r22_code"] = f"""{_with(LINES)}
SELECT identity_line_item_id, line_item_product_code, line_item_unblended_cost FROM lines
WHERE line_item_product_code LIKE '%OCB%' AND line_item_product_code != 'OCBPremiumSupport' AND {TYPE} = 'Fee'"""
ORACLE["report_r22_tag"] = f"""{_with(LINES)}
SELECT resource_tags_user_component, line_item_usage_start_date::DATE AS line_item_usage_start_date, identity_line_item_id
FROM lines WHERE resource_tags_user_name = 'svc-7' AND resource_tags_user_component = '1-URGENT'"""
ORACLE["report_r22_summary"] = f"""SELECT usage_date, linked_account_id, service, amortized_cost
FROM ({ORACLE["cost_summary"]}) WHERE line_item_product_code = 'AmazonGlacier' AND year = 1998
ORDER BY usage_date, linked_account_id, service, amortized_cost LIMIT 10"""
ORACLE["report_r23"] = _with(_metrics("rds")) + """SELECT DISTINCT day FROM metrics WHERE namespace = 'AWSRDS'
  AND json_extract_string(dimensions, '$.DBInstanceIdentifier') = 'i-7' AND metric_name = 'DatabaseConnections'"""

ORACLE["reconcile_totals"] = f"""{_with(LINES, CODES)}
SELECT date_dim_id, round(coalesce(from_lines, 0), 4) AS from_lines, round(coalesce(from_fact, 0), 4) AS from_fact,
  round(coalesce(from_lines, 0) - coalesce(from_fact, 0), 4) + 0.0::DOUBLE AS difference
FROM (SELECT {DAY_ID} AS date_dim_id, sum({_amortized()}) AS from_lines FROM lines WHERE {KEPT} AND {RDS_LINE} GROUP BY ALL)
FULL JOIN (SELECT {DAY_ID} AS date_dim_id, sum({_amortized()}) AS from_fact
  FROM (SELECT *, {RESOLVED} AS resolved FROM lines) WHERE {KEPT} AND resolved = '{RDS}' GROUP BY ALL) USING (date_dim_id)"""

ORACLE["upsert_bucketed"] = ORACLE["upsert_usage_table"]
ORACLE["appended_days"] = ORACLE["usage_s3"]
ORACLE["dimension_load"] = f"SELECT * FROM ({ORACLE['star_load']}) WHERE frame <> 'fact'"
ORACLE["summary_view"] = f"""{_with(*STAR)}SELECT d.year_attr, d.month_attr, a.account_name, {COST}
FROM fact f {JOIN_D} JOIN (SELECT DISTINCT aws_account_dim_id, account_name FROM account_dim) a
  ON f.aws_account_dim_id = a.aws_account_dim_id WHERE d.year_attr = '1998' GROUP BY ALL"""
ORACLE["declared_schema_scan"] = f"""{_with(LINES)}
SELECT line_item_usage_account_id, line_item_resource_id, NULL::VARCHAR AS line_item_operation,
  resource_tags_user_component, resource_tags_user_name, resource_tags_user_squad, year, month,
  round(line_item_unblended_cost, 4) AS line_item_unblended_cost FROM lines WHERE year = 1998 AND month = 4"""
ORACLE["reconcile_by_checksums"] = f"""{_with(*TWO)}
SELECT date_dim_id, aws_account_dim_id, round(sum(amortized_cost), 4) AS left,
  round(sum(amortized_cost) + count(*), 4) AS right, -count(*)::DOUBLE AS difference
FROM ({_fact('keyed_1')} UNION ALL {_fact('keyed_2')})
WHERE date_dim_id IN ('19980401', '19980502') AND aws_account_dim_id = 'A3' GROUP BY ALL"""
ORACLE["usage_late_records"] = ORACLE["usage_ec2"]
