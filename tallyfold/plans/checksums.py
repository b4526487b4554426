"""Reconciling two stored facts by checksums of their days.

Days whose checksums agree hold the same rows and are not read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.cost_fact import FACT_KEYS, FACT_MEASURES
from tallyfold.plans.star import PRODUCT_KEY, TAG_KEY, USAGE_MONTH
from tallyfold.sources.bookmarks import with_partitions

DAY = "date_dim_id"
DIGITS = 4  # of measures: engines add doubles in different orders


def day_checksums(fact: DataFrame, measures: Sequence[str] = FACT_MEASURES) -> DataFrame:
    """One row per day: number of rows, sums, and the sum of the rows' hashes, in any order of rows.

    Hashes add up as decimals, so equal rows do not cancel each other. Store it
    beside the fact when the fact is written.
    """
    exact = {m: F.round(F.col(m), DIGITS).cast(f"decimal(28,{DIGITS})") for m in measures}
    row = F.xxhash64(*FACT_KEYS, TAG_KEY, PRODUCT_KEY, *exact.values()).cast("decimal(38,0)")
    return fact.groupBy(USAGE_MONTH, DAY).agg(
        F.count("*").alias("rows"), *[F.sum(c).alias(m) for m, c in exact.items()], F.sum(row).alias("row_hash")
    )


def differing_days(left: DataFrame, right: DataFrame) -> list[dict[str, object]]:
    """Days that only one of two checksum tables has, or that differ; at most one per day reaches the driver."""
    days, compared = [USAGE_MONTH, DAY], [c for c in left.columns if c not in (USAGE_MONTH, DAY)]
    other = right.select(*days, *[F.col(c).alias(f"_{c}") for c in compared])
    differ = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in compared])
    return [r.asDict() for r in left.join(other, days, "full").where(differ).select(*days).orderBy(*days).collect()]


def reconcile_days(
    left: DataFrame, right: DataFrame, days: Sequence[dict[str, object]], keys: Sequence[str], measure: str
) -> DataFrame:
    """The measure by ``keys`` on both sides of the given days, where it differs.

    Days are named by the stored fact's month of usage and day: the first prunes
    folders, the second row groups.
    """

    def totals(fact: DataFrame, name: str) -> DataFrame:
        return with_partitions(fact, days).groupBy(*keys).agg(F.round(F.sum(measure), DIGITS).alias(name))

    joined = totals(left, "_left").withColumnsRenamed({k: f"_l_{k}" for k in keys})
    other = totals(right, "_right")
    same = [F.col(f"_l_{k}").eqNullSafe(F.col(k)) for k in keys]
    both = joined.join(other, reduce(lambda a, b: a & b, same), "full")
    first, second = F.coalesce("_left", F.lit(0.0)), F.coalesce("_right", F.lit(0.0))
    return both.select(
        *[F.coalesce(F.col(f"_l_{k}"), F.col(k)).alias(k) for k in keys],
        first.alias("left"), second.alias("right"), F.round(first - second, DIGITS).alias("difference"),
    ).where("difference <> 0")
