"""Usage from counted values, which add up: late records change counts, not days.

For every resource, hour and field the distinct values are kept with the number
of records that have them. Sums, means, extremes and exact percentiles all follow
from these counts, and counts of two sets of records are added, or subtracted
where a record was corrected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.percentiles import percentile_array
from tallyfold.operators.usage import RESOURCE_DAY, MetricSpec, metric_values, tagged_usage

GROUP = (*RESOURCE_DAY, "metric_hour", "metric_name", "field")
ENTRIES = "entries"


def value_counts(changes: DataFrame, spec: MetricSpec) -> DataFrame:
    """Signed counts (group columns, v, n) of the fields a spec reads, from records with a ``sign``.

    A null value is counted too: it tells that the metric was there.
    """
    wanted = sorted({(m.metric, m.field) for m in spec.measures})
    rows = metric_values(changes, spec, extra=("sign",))
    pairs = F.array(
        *[
            F.when(F.col("metric_name") == metric, F.struct(F.lit(field).alias("field"), F.col(field).cast("double").alias("v")))
            for metric, field in wanted
        ]
    )
    long = rows.withColumn("pair", F.explode(F.array_compact(pairs)))
    keys = [c for c in GROUP if c != "field"]
    return long.groupBy(*keys, F.col("pair.field").alias("field"), F.col("pair.v").alias("v")).agg(F.sum("sign").alias("n"))


def folded(counts: DataFrame) -> DataFrame:
    """One row per group with its values and counts; a group whose counts are all zero keeps its row."""
    entry = F.when(F.col("n") != 0, F.struct("v", "n"))
    return counts.groupBy(*GROUP).agg(F.collect_list(entry).alias(ENTRIES))


def unfolded(stored: DataFrame) -> DataFrame:
    """Counts (group columns, v, n) of stored rows; an empty row gives a count of zero."""
    each = stored.select(*GROUP, F.explode_outer(ENTRIES).alias("e"))
    return each.select(*GROUP, F.col("e.v").alias("v"), F.coalesce("e.n", F.lit(0)).cast("bigint").alias("n"))


def merged(parts: list[DataFrame]) -> DataFrame:
    """Counts of several sets of records added up. One shuffle, combined before it."""
    union = reduce(lambda a, b: a.unionByName(b), [p.select(*GROUP, "v", "n") for p in parts])
    return union.groupBy(*GROUP, "v").agg(F.sum("n").alias("n"))


def usage_of_counts(counts: DataFrame, spec: MetricSpec, tag_map: DataFrame) -> DataFrame:
    """The usage fact of ``daily_usage``, from counts. A group is one resource's day, which bounds it."""
    there = counts.where("n > 0")

    def of(metric: str, field: str, column: Column) -> Column:
        return F.when((F.col("metric_name") == metric) & (F.col("field") == field), column)

    v, n = F.col("v"), F.col("n")
    aggregates, hourly = [], {}
    for m in spec.measures:
        value, times = of(m.metric, m.field, v), of(m.metric, m.field, n)
        if m.how == "sum":
            aggregates.append(F.sum(value * n).alias(m.name))
        elif m.how == "avg":
            known = F.when(value.isNotNull(), times)
            aggregates.append((F.sum(value * n) / F.sum(known)).alias(m.name))
        elif m.how in ("max", "min"):
            aggregates.append(getattr(F, m.how)(value).alias(m.name))
        elif m.how == "percentile":
            picked = F.percentile(value, percentile_array([m.p]), F.coalesce(times, F.lit(0)))
            aggregates.append(F.element_at(picked, 1).alias(m.name))
        else:
            hourly[m.name] = F.element_at(F.percentile(value, percentile_array([m.p]), F.coalesce(times, F.lit(0))), 1)
    present = {f"_has_{i}": F.max(F.when(F.col("metric_name") == metric, F.lit(True))) for i, metric in enumerate(spec.metrics)}
    days = there.groupBy(*RESOURCE_DAY).agg(*aggregates, *[c.alias(name) for name, c in present.items()])
    for name in present:
        days = days.where(F.col(name))
    days = days.drop(*present)
    if hourly:
        hours = there.groupBy(*RESOURCE_DAY, "metric_hour").agg(*[c.alias(name) for name, c in hourly.items()])
        days = days.join(hours.groupBy(*RESOURCE_DAY).agg(*[F.max(name).alias(name) for name in hourly]), list(RESOURCE_DAY), "left")
    return tagged_usage(days, spec, tag_map)
