"""Charge classification and cost rules over one billing line.

``has_reservations=False`` is the second payer export, which carries no
reservation identifier: its reserved branches disappear and every ``Fee``
counts as an upfront commitment fee.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold.functions import fixed_values as V
from tallyfold.functions.calendar import as_timestamp, year_month

CHARGE = "line_item_line_item_type"
SAVINGS_PLAN = "savings_plan_savings_plan_a_r_n"
RESERVATION = "reservation_reservation_a_r_n"


def _charge_is(*names: str) -> Column:
    return F.col(CHARGE).isin(*names)


def _filled(name: str) -> Column:
    return F.col(name) != ""


def _commitment_fee(has_reservations: bool) -> Column:
    fee = _charge_is("Fee")
    return fee & _filled(RESERVATION) if has_reservations else fee


def charge_category() -> Column:
    return F.when(_charge_is(*V.RUNNING_USAGE_TYPES), "Running_Usage").otherwise("non_usage")


def purchase_option(has_reservations: bool = True) -> Column:
    option = F.when(_filled(SAVINGS_PLAN), "SavingsPlan")
    if has_reservations:
        option = option.when(_filled(RESERVATION), "Reserved")
    return option.when(F.col("line_item_usage_type").contains("Spot"), "Spot").otherwise("OnDemand")


def commitment_arn(has_reservations: bool = True) -> Column:
    arn = F.when(_filled(SAVINGS_PLAN), F.col(SAVINGS_PLAN))
    if has_reservations:
        arn = arn.when(_filled(RESERVATION), F.col(RESERVATION))
    return arn.otherwise("")


def service() -> Column:
    on_marketplace = (F.col("bill_billing_entity") == V.MARKETPLACE) & ~F.col(CHARGE).contains("Discount")
    return (
        F.when(on_marketplace, F.col("product_product_name"))
        .when(F.col("product_servicecode") == "", F.col("line_item_product_code"))
        .otherwise(F.col("product_servicecode"))
    )


def service_name(listed_name: Column) -> Column:
    """Resolved service name; ``listed_name`` is the code's entry in the name
    table, null for a code that is not listed ('' is a listed name)."""
    name, code = F.col("product_servicename"), F.col("line_item_product_code")
    unnamed = name == ""
    return (
        F.when((name == V.DATA_TRANSFER) & listed_name.isNotNull(), listed_name)
        .when(unnamed & code.isin(*V.UNNAMED_SERVICE_CODES), listed_name)
        .when(unnamed & (code == V.CODE_NAMED_FEE) & _charge_is("Fee"), code)
        .when(
            unnamed & (F.col("bill_billing_entity") == V.MARKETPLACE),
            F.concat(F.lit(V.MARKETPLACE + " "), F.col("product_product_name")),
        )
        .otherwise(name)
    )


def spot_detail() -> dict[str, Column]:
    """Instance family, type and platform: from the description of a spot
    compute line, else from the product columns."""
    text = F.col("line_item_line_item_description")
    spot = (
        F.col("line_item_usage_type").contains("Spot")
        & (F.col("line_item_product_code") == "AmazonEC2")
        & _charge_is("Usage")
    )

    def part(column: Column, mark: str, position: int) -> Column:
        return F.split_part(column, F.lit(mark), F.lit(position))

    return {
        "instance_type_family": F.when(spot, part(text, ".", 1)).otherwise(F.col("product_instance_type_family")),
        "instance_type": F.when(spot, part(text, " ", 1)).otherwise(F.col("product_instance_type")),
        "platform": F.when(spot, part(part(text, " ", 2), "/", 1)).otherwise(F.col("product_operating_system")),
    }


def usage_quantity() -> Column:
    return F.when(_charge_is(*V.RUNNING_USAGE_TYPES), F.col("line_item_usage_amount")).otherwise(0.0)


def unblended_cost() -> Column:
    return F.col("line_item_unblended_cost")


def amortized_cost(has_reservations: bool = True, open_month: object | None = None) -> Column:
    """Cost with commitments spread over the usage they cover.

    With ``open_month`` (any date in it) a reservation fee of that month
    counts only its unused upfront part: the recurring part is not final.
    """
    unused_upfront = F.col("reservation_unused_amortized_upfront_fee_for_billing_period")
    unused = unused_upfront + F.col("reservation_unused_recurring_fee")
    if open_month is not None:
        still_open = year_month(F.col("line_item_usage_start_date")) == year_month(as_timestamp(open_month))
        unused = F.when(still_open, unused_upfront).otherwise(unused)
    return (
        F.when(_charge_is("SavingsPlanCoveredUsage"), F.col("savings_plan_savings_plan_effective_cost"))
        .when(
            _charge_is("SavingsPlanRecurringFee"),
            F.col("savings_plan_total_commitment_to_date") - F.col("savings_plan_used_commitment"),
        )
        .when(_charge_is("SavingsPlanNegation", "SavingsPlanUpfrontFee"), 0.0)
        .when(_charge_is("DiscountedUsage"), F.col("reservation_effective_cost"))
        .when(_charge_is("RIFee"), unused)
        .when(_commitment_fee(has_reservations), 0.0)
        .otherwise(unblended_cost())
    )


def commitment_trueup() -> Column:
    return (
        F.when(
            _charge_is("SavingsPlanRecurringFee"),
            -F.col("savings_plan_amortized_upfront_commitment_for_billing_period"),
        )
        .when(_charge_is("RIFee"), -F.col("reservation_amortized_upfront_fee_for_billing_period"))
        .otherwise(0.0)
    )


def commitment_upfront_fees(has_reservations: bool = True) -> Column:
    upfront = _charge_is("SavingsPlanUpfrontFee") | _commitment_fee(has_reservations)
    return F.when(upfront, unblended_cost()).otherwise(0.0)


def public_cost() -> Column:
    return F.when(F.col(CHARGE) != "SavingsPlanNegation", F.col("pricing_public_on_demand_cost")).otherwise(0.0)


def line_measures(has_reservations: bool = True, open_month: object | None = None) -> dict[str, Column]:
    """Every additive measure of a line, by its name in the summary."""
    return {
        "usage_quantity": usage_quantity(),
        "unblended_cost": unblended_cost(),
        "amortized_cost": amortized_cost(has_reservations, open_month),
        "ri_sp_trueup": commitment_trueup(),
        "ri_sp_upfront_fees": commitment_upfront_fees(has_reservations),
        "public_cost": public_cost(),
    }


def is_masked() -> Column:
    """True for lines whose description and amounts must not be shown."""
    refund_type, refund_text = V.MASKED_REFUND
    tests = [_charge_is(refund_type) & (F.col("line_item_line_item_description") == refund_text)]
    for usage, product in V.MASKED_USAGE:
        test = F.col("line_item_usage_type").like(usage)
        tests.append(test & F.col("product_product_name").like(product) if product else test)
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False))
