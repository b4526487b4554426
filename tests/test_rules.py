"""Cost rules on single lines."""

import pytest
from pyspark.sql import functions as F

from registry.inputs import plain_text
from tallyfold.functions import cost_rules as R
from tallyfold.functions.fixed_values import PRODUCT_CODE_NAMES
from tallyfold.operators.masking import mask_costs
from tallyfold.operators.service_names import resolve_service_name

DEFAULTS = {
    "line_item_line_item_type": "Usage",
    "savings_plan_savings_plan_a_r_n": "",
    "reservation_reservation_a_r_n": "",
    "line_item_usage_type": "BoxUsage:m5",
    "line_item_product_code": "AmazonEC2",
    "bill_billing_entity": "AWS",
    "product_product_name": "Name",
    "product_servicecode": "code",
    "product_servicename": "Some Service",
    "line_item_line_item_description": "m5.large Linux/UNIX Spot",
    "product_instance_type_family": "fam",
    "product_instance_type": "typ",
    "product_operating_system": "os",
    "line_item_usage_start_date": "2022-04-10 05:00:00",
    "line_item_unblended_rate": "2.5",
    "line_item_blended_rate": "2.4",
    "line_item_usage_amount": 3.0,
    "line_item_unblended_cost": 100.0,
    "line_item_blended_cost": 90.0,
    "pricing_public_on_demand_cost": 120.0,
    "reservation_effective_cost": 60.0,
    "reservation_unused_amortized_upfront_fee_for_billing_period": 7.0,
    "reservation_unused_recurring_fee": 5.0,
    "reservation_amortized_upfront_fee_for_billing_period": 11.0,
    "savings_plan_savings_plan_effective_cost": 70.0,
    "savings_plan_total_commitment_to_date": 50.0,
    "savings_plan_used_commitment": 40.0,
    "savings_plan_amortized_upfront_commitment_for_billing_period": 13.0,
}


def line(spark, **values):
    merged = {**DEFAULTS, **values}
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in DEFAULTS.items())
    return spark.createDataFrame([tuple(merged[k] for k in DEFAULTS)], schema)


def value(df, column):
    return df.select(column.alias("v")).first()["v"]


def typed(spark, kind, **values):
    return line(spark, line_item_line_item_type=kind, **values)


def test_charge_category(spark):
    assert value(typed(spark, "DiscountedUsage"), R.charge_category()) == "Running_Usage"
    assert value(typed(spark, None), R.charge_category()) == "non_usage"


def test_purchase_option_order_and_nulls(spark):
    both = line(spark, savings_plan_savings_plan_a_r_n="sp", reservation_reservation_a_r_n="ri", line_item_usage_type="SpotUsage")
    assert value(both, R.purchase_option()) == "SavingsPlan"
    reserved = line(spark, reservation_reservation_a_r_n="ri", line_item_usage_type="SpotUsage")
    assert value(reserved, R.purchase_option()) == "Reserved"
    assert value(reserved, R.purchase_option(False)) == "Spot"
    nothing = line(spark, savings_plan_savings_plan_a_r_n=None, reservation_reservation_a_r_n=None, line_item_usage_type=None)
    assert value(nothing, R.purchase_option()) == "OnDemand"
    assert value(reserved, R.commitment_arn()) == "ri"
    assert value(reserved, R.commitment_arn(False)) == ""


@pytest.mark.parametrize(
    ("kind", "arn", "first", "second"),
    [
        ("SavingsPlanCoveredUsage", "", 70.0, 70.0),
        ("SavingsPlanRecurringFee", "", 10.0, 10.0),
        ("SavingsPlanNegation", "", 0.0, 0.0),
        ("SavingsPlanUpfrontFee", "", 0.0, 0.0),
        ("DiscountedUsage", "", 60.0, 60.0),
        ("RIFee", "", 12.0, 12.0),
        ("Fee", "ri", 0.0, 0.0),
        ("Fee", "", 100.0, 0.0),
        ("Fee", None, 100.0, 0.0),
        ("Usage", "ri", 100.0, 100.0),
        (None, "", 100.0, 100.0),
    ],
)
def test_amortized_cost(spark, kind, arn, first, second):
    df = typed(spark, kind, reservation_reservation_a_r_n=arn)
    assert value(df, R.amortized_cost()) == first
    assert value(df, R.amortized_cost(False)) == second


def test_amortized_cost_of_an_open_month(spark):
    fee = typed(spark, "RIFee")
    assert value(fee, R.amortized_cost(open_month="2022-04-30")) == 7.0
    assert value(fee, R.amortized_cost(open_month="2022-05-01")) == 12.0


def test_other_measures(spark):
    assert value(typed(spark, "SavingsPlanRecurringFee"), R.commitment_trueup()) == -13.0
    assert value(typed(spark, "RIFee"), R.commitment_trueup()) == -11.0
    assert value(typed(spark, "Usage"), R.commitment_trueup()) == 0.0
    assert value(typed(spark, "SavingsPlanUpfrontFee"), R.commitment_upfront_fees()) == 100.0
    assert value(typed(spark, "Fee"), R.commitment_upfront_fees()) == 0.0
    assert value(typed(spark, "Fee"), R.commitment_upfront_fees(False)) == 100.0
    assert value(typed(spark, "SavingsPlanNegation"), R.public_cost()) == 0.0
    assert value(typed(spark, None), R.public_cost()) == 0.0
    assert value(typed(spark, "Tax"), R.usage_quantity()) == 0.0
    assert value(typed(spark, "Usage"), R.usage_quantity()) == 3.0


def test_service(spark):
    shop = {"bill_billing_entity": "AWS Marketplace"}
    assert value(line(spark, **shop), R.service()) == "Name"
    assert value(typed(spark, "DiscountedUsage", **shop), R.service()) == "code"
    assert value(line(spark, product_servicecode=""), R.service()) == "AmazonEC2"


@pytest.mark.parametrize(
    ("name", "code", "kind", "entity", "expected"),
    [
        ("AWS Data Transfer", "AmazonRDS", "Usage", "AWS", "Amazon Relational Database Service"),
        ("AWS Data Transfer", "AmazonGlacier", "Usage", "AWS Marketplace", ""),
        ("AWS Data Transfer", "Unlisted", "Usage", "AWS", "AWS Data Transfer"),
        ("", "AmazonEC2", "Usage", "AWS Marketplace", "Amazon Elastic Compute Cloud"),
        ("", "AmazonS3", "Usage", "AWS", ""),
        ("", "OCBElasticComputeCloud", "Fee", "AWS Marketplace", "OCBElasticComputeCloud"),
        ("", "OCBElasticComputeCloud", "Usage", "AWS Marketplace", "AWS Marketplace Name"),
        ("Kept", "AmazonEC2", "Usage", "AWS Marketplace", "Kept"),
        (None, "AmazonEC2", "Usage", "AWS Marketplace", None),
    ],
)
def test_service_name(spark, name, code, kind, entity, expected):
    df = typed(spark, kind, product_servicename=name, line_item_product_code=code, bill_billing_entity=entity)
    assert resolve_service_name(df, "resolved").first()["resolved"] == expected


def test_code_table():
    assert len(PRODUCT_CODE_NAMES) == 89
    assert sum(name == "" for name in PRODUCT_CODE_NAMES.values()) == 9


def test_spot_detail(spark):
    spot = line(spark, line_item_usage_type="SpotUsage:m5.large").select(*[c.alias(n) for n, c in R.spot_detail().items()])
    assert tuple(spot.first()) == ("m5", "m5.large", "Linux")
    plain = line(spark).select(*[c.alias(n) for n, c in R.spot_detail().items()])
    assert tuple(plain.first()) == ("fam", "typ", "os")


@pytest.mark.parametrize(
    ("values", "masked"),
    [
        ({"line_item_line_item_type": "Refund", "line_item_line_item_description": "Enterprise Program Discount"}, True),
        ({"line_item_line_item_type": "Credit", "line_item_line_item_description": "Enterprise Program Discount"}, False),
        ({"line_item_usage_type": "X-TimedStorage-ByteHrs-Y", "product_product_name": "The Amazon Simple Storage Service"}, True),
        ({"line_item_usage_type": "TimedStorage-GlacierByteHrs", "product_product_name": "Amazon Simple Storage Service"}, True),
        ({"line_item_usage_type": "TimedStorage-ByteHrs", "product_product_name": "Other"}, False),
        ({"line_item_usage_type": "US-Requests-HTTP-Proxy", "product_product_name": "Amazon CloudFront"}, True),
        ({"line_item_usage_type": "US-Requests-HTTPS-Proxy", "product_product_name": "Amazon CloudFront"}, True),
        ({"line_item_usage_type": "US-Requests-HTTPS-Proxy-2", "product_product_name": "Amazon CloudFront"}, False),
        ({"line_item_usage_type": "US-DataTransfer-Out-Bytes", "product_product_name": "Amazon CloudFront"}, True),
        ({"line_item_usage_type": "DataTransfer-Regional-Bytes", "product_product_name": None}, True),
        ({"line_item_usage_type": None, "product_product_name": None}, False),
    ],
)
def test_masking(spark, values, masked):
    row = mask_costs(line(spark, **values)).first()
    if masked:
        assert row["line_item_line_item_description"] == "Masked description"
        assert (row["line_item_unblended_rate"], row["line_item_blended_rate"]) == ("0.01", "0.01")
        assert (row["line_item_unblended_cost"], row["line_item_blended_cost"]) == (0.01, 0.01)
    else:
        assert row["line_item_unblended_rate"] == "2.5"
        assert row["line_item_unblended_cost"] == 100.0
    assert set(mask_costs(line(spark)).columns) == set(DEFAULTS)


def test_cleaning_does_not_copy_expressions(spark):
    """Cleaning many times over must not grow the expression."""
    from tallyfold.functions.keys import with_clean_columns

    df = line(spark).withColumn("t", F.upper("product_product_name"))
    for _ in range(12):
        df = with_clean_columns(df, ["t"])
    plan = df.select("t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") <= 1


def test_numbers_of_responses_have_no_exponent(spark):
    used = [0.0, 0.05, 7.5, -3.0, 12.34, 9999999.99, 10000000.0, 123456789.1, None]
    found = spark.createDataFrame([(u,) for u in used], "used double").select(plain_text("used")).collect()
    assert [r[0] for r in found] == ["0.0", "0.05", "7.5", "-3.0", "12.34", "9999999.99", "10000000.0", "123456789.1", None]
