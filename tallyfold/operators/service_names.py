"""Service names from product codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.cost_rules import service_name
from tallyfold.functions.fixed_values import PRODUCT_CODE_NAMES

LISTED_NAME = "listed_service_name"


def product_codes(spark: SparkSession) -> DataFrame:
    """The code table: one row per listed code, 89 rows whatever the data."""
    rows = ", ".join(f"('{code}', '{name}')" for code, name in PRODUCT_CODE_NAMES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS codes(line_item_product_code, {LISTED_NAME})")


def with_listed_name(df: DataFrame) -> DataFrame:
    """Add the listed name of each row's product code, null if unlisted.

    The broadcast side is the fixed 89-row table, so no size check is needed.
    """
    return df.join(F.broadcast(product_codes(df.sparkSession)), "line_item_product_code", "left")


def resolve_service_name(df: DataFrame, output: str = "product_servicename") -> DataFrame:
    return with_listed_name(df).withColumn(output, service_name(F.col(LISTED_NAME))).drop(LISTED_NAME)
