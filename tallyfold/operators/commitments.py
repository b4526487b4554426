"""Reservation and savings-plan series from landed responses."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.reshape import all_to_string, flatten

# The member holding the series in each response.
RI_UTILIZATION = "UtilizationsByTime"
RI_COVERAGE = "CoveragesByTime"
SAVINGS_COVERAGE = "SavingsPlansCoverages"
SAVINGS_UTILIZATION = "SavingsPlansUtilizationsByTime"


def landed_series(
    responses: DataFrame, member: str, period: tuple[dt.date, dt.date] | None = None
) -> DataFrame:
    """One row per period of the responses' series; optionally those starting
    in a reporting period (first day included, last excluded, see
    ``calendar.reporting_period``)."""
    series = responses.select(F.inline(F.col(member)))
    if period is None:
        return series
    first, last = (day.isoformat() for day in period)
    return series.where((F.col("TimePeriod.Start") >= first) & (F.col("TimePeriod.Start") < last))


def commitment_series(responses: Mapping[str | None, DataFrame], *, strip_total: bool) -> DataFrame:
    """Flat text columns per period, over all services.

    ``responses`` maps a service name to its series (see ``landed_series``);
    a single series without a service goes under ``None``. Nested members get
    their path as name, with ``Total_`` removed on request; the period becomes
    ``date_dim_id`` (its start day). Missing members stay null.
    """
    parts = []
    for service, series in responses.items():
        part = series if service is None else series.withColumn("service_name", F.lit(service))
        part = part.withColumn("date_dim_id", F.replace(F.col("TimePeriod.Start"), F.lit("-"), F.lit("")))
        parts.append(flatten(part.drop("TimePeriod"), strip="Total_" if strip_total else ""))
    return all_to_string(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))


def ri_utilization(responses: Mapping[str, DataFrame]) -> DataFrame:
    return commitment_series(responses, strip_total=True)


def ri_coverage(responses: Mapping[str, DataFrame]) -> DataFrame:
    return commitment_series(responses, strip_total=True)


def savings_coverage(responses: Mapping[str, DataFrame]) -> DataFrame:
    return commitment_series(responses, strip_total=False)


def savings_utilization(series: DataFrame) -> DataFrame:
    return commitment_series({None: series}, strip_total=False)
