"""Data-transfer cost by service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.calendar import date_dim_id
from tallyfold.functions.fixed_values import DATA_TRANSFER
from tallyfold.operators.service_names import LISTED_NAME, product_codes


def data_transfer_cost(summaries: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Amortized data-transfer cost per product code, account and day.

    Input rows carry the *unresolved* service name (``summary`` or
    ``fact_lines`` with ``resolve_names=False``): resolution renames exactly
    the rows counted here. Codes without transfer cost keep a
    row with 0. The day is part of the grain because the load replaces rows by
    day and account.

    One shuffle; the name table (89 rows unless the caller brings another)
    joins the aggregate, so broadcasting is left to the optimizer's size check.
    """
    codes = product_codes(summaries.sparkSession) if codes is None else codes
    counted = F.when(F.col("product_servicename") == DATA_TRANSFER, F.col("amortized_cost")).otherwise(0.0)
    listed = F.col(LISTED_NAME)
    return (
        summaries.groupBy(
            "line_item_product_code",
            "linked_account_id",
            F.to_date("usage_date").alias("usage_day"),
            "year",
            "month",
        )
        .agg(F.sum(counted).alias("transfer"))
        .join(codes, "line_item_product_code", "left")
        .select(
            F.coalesce(listed, F.lit("")).alias("product_servicename"),
            "line_item_product_code",
            "linked_account_id",
            date_dim_id(F.col("usage_day")).alias("date_dim_id"),
            "year",
            "month",
            F.when(listed.isNotNull(), F.col("transfer")).otherwise(0.0).alias("DT_cost"),
        )
    )
