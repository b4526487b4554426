"""Cost masking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.cost_rules import is_masked
from tallyfold.functions.fixed_values import MASKED_AMOUNT, MASKED_DESCRIPTION

MASKED_COLUMNS = {
    "line_item_line_item_description": MASKED_DESCRIPTION,
    "line_item_unblended_rate": MASKED_AMOUNT,
    "line_item_unblended_cost": MASKED_AMOUNT,
    "line_item_blended_rate": MASKED_AMOUNT,
    "line_item_blended_cost": MASKED_AMOUNT,
}


def mask_costs(lines: DataFrame) -> DataFrame:
    """Hide description, rates and costs of the lines ``is_masked`` names.

    The test runs once per line on the unmasked values. Replacements take the
    type of the column they go into (rates are text in the export).
    """
    types = {f.name.lower(): f.dataType for f in lines.schema.fields}
    masked = F.col("_masked")
    return (
        lines.withColumn("_masked", is_masked())
        .withColumns(
            {
                name: F.when(masked, F.lit(value).cast(types[name])).otherwise(F.col(name))
                for name, value in MASKED_COLUMNS.items()
                if name in types
            }
        )
        .drop("_masked")
    )
