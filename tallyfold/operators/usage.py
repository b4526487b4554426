"""Daily usage facts from metric records."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.calendar import calendar_columns, date_dim_id, epoch_millis_to_timestamp
from tallyfold.functions.text import json_text, last_segment
from tallyfold.operators.latest import current_tag_map
from tallyfold.operators.percentiles import exact_percentiles, percentile_array

RESOURCE_DAY = ("resource", "account_id", "metric_date")
# Mean of a record: value_sum / value_count, null for a count of 0.
MEAN = "value_mean"


@dataclasses.dataclass(frozen=True)
class Measure:
    """One output column: ``how`` over ``field`` of the records of ``metric``.

    ``how`` is sum, avg, max, percentile (with ``p``) or max_hourly_percentile
    (the largest of the day's hourly percentiles).
    """

    name: str
    metric: str
    how: str
    field: str = "value_sum"
    p: float | None = None


@dataclasses.dataclass(frozen=True)
class MetricSpec:
    service: str
    namespace: str
    json_key: str
    measures: tuple[Measure, ...]
    id_is_path: bool = False

    @property
    def metrics(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(m.metric for m in self.measures))

    def with_how(self, name: str, how: str, field: str | None = None) -> "MetricSpec":
        """The same rollup with another aggregate (or field) for one measure."""
        changed = tuple(
            dataclasses.replace(m, how=how, field=field or m.field) if m.name == name else m for m in self.measures
        )
        return dataclasses.replace(self, measures=changed)

    def sums_as_max(self) -> "MetricSpec":
        """The planned variant: every summed measure becomes a maximum."""
        changed = tuple(dataclasses.replace(m, how="max") if m.how == "sum" else m for m in self.measures)
        return dataclasses.replace(self, measures=changed)

    def without(self, *names: str) -> "MetricSpec":
        """The same rollup with fewer output columns."""
        return dataclasses.replace(self, measures=tuple(m for m in self.measures if m.name not in names))


# Metrics, dimension keys and aggregates of the seven services.
EC2 = MetricSpec(
    "ec2",
    "AWSEC2",
    "InstanceId",
    (
        Measure("p95_cpu", "CPUUtilization", "percentile", MEAN, 0.95),
        Measure("p99_cpu", "CPUUtilization", "percentile", MEAN, 0.99),
        Measure("p90_cpu", "CPUUtilization", "percentile", MEAN, 0.90),
        Measure("p50_cpu", "CPUUtilization", "percentile", MEAN, 0.50),
        Measure("max_p99", "CPUUtilization", "max_hourly_percentile", MEAN, 0.99),
        Measure("avg_cpu", "CPUUtilization", "avg", MEAN),
        Measure("network_in", "NetworkIn", "sum"),
        Measure("network_out", "NetworkOut", "sum"),
    ),
)
RDS = MetricSpec(
    "rds",
    "AWSRDS",
    "DBInstanceIdentifier",
    (
        Measure("max_cpu", "CPUUtilization", "max"),
        Measure("avg_cpu", "CPUUtilization", "avg"),
        Measure("database_connections", "DatabaseConnections", "sum"),
        Measure("network_receive_throughput", "NetworkReceiveThroughput", "sum"),
    ),
)
ELASTICACHE = MetricSpec(
    "elasticache",
    "AWSElastiCache",
    "CacheClusterId",
    (
        Measure("max_cpu", "EngineCPUUtilization", "max"),
        Measure("avg_cpu", "EngineCPUUtilization", "avg"),
        Measure("database_memory_usage_percentage", "DatabaseMemoryUsagePercentage", "avg"),
        Measure("curr_connections", "CurrConnections", "sum"),
    ),
)
ALB = MetricSpec(
    "alb",
    "AWSApplicationELB",
    "LoadBalancer",
    (
        Measure("healthy_host_count", "HealthyHostCount", "max", "value_max"),
        Measure("request_count", "RequestCount", "max", "value_max"),
        Measure("consumed_lcus", "ConsumedLCUs", "max", "value_max"),
    ),
    id_is_path=True,
)
ELB = MetricSpec(
    "elb",
    "ELB",
    "LoadBalancerName",
    (
        Measure("consumed_lcus", "ConsumedLCUs", "sum"),
        Measure("pre_warmed_lcus", "PreWarmedLCUs", "sum"),
    ),
)
S3 = MetricSpec(
    "s3",
    "AWSS3",
    "BucketName",
    (
        Measure("get_requests", "GetRequests", "sum"),
        Measure("put_requests", "PutRequests", "sum"),
    ),
)
EBS = MetricSpec(
    "ebs",
    "AWSEBS",
    "VolumeId",
    (
        Measure("volume_read_bytes", "VolumeReadBytes", "sum"),
        Measure("volume_write_bytes", "VolumeWriteBytes", "sum"),
    ),
)
SPECS = {s.service: s for s in (EC2, RDS, ELASTICACHE, ALB, ELB, S3, EBS)}


def flatten_value(metrics: DataFrame) -> DataFrame:
    """``value{min,max,sum,count}`` as four columns; no-op when already flat."""
    if "value" not in metrics.columns:
        return metrics
    members = {f"value_{m}": F.col(f"value.{m}") for m in ("min", "max", "sum", "count")}
    return metrics.withColumns(members).drop("value")


def _on_days(metrics: DataFrame, days: Iterable[dt.date]) -> DataFrame:
    """Keep whole days by their integer partition columns (prunes the scan)."""
    wanted = [F.struct(F.lit(d.year), F.lit(d.month), F.lit(d.day)) for d in days]
    return metrics.where(F.struct("year", "month", "day").isin(*wanted))


def metric_values(metrics: DataFrame, spec: MetricSpec, extra: Sequence[str] = ()) -> DataFrame:
    """Records of the spec's metrics with resource, day and hour.

    Both filters are on plain columns, so they reach the file scan. Records
    without resource or account never find a tag row: dropping them here keeps
    the result and spares their group.
    """
    resource = json_text(F.col("dimensions"), spec.json_key)
    stamp = epoch_millis_to_timestamp(F.col("timestamp"))
    chosen = flatten_value(metrics).where(
        (F.col("namespace") == spec.namespace) & F.col("metric_name").isin(*spec.metrics)
    )
    return chosen.select(
        (last_segment(resource) if spec.id_is_path else resource).alias("resource"),
        "account_id",
        stamp.cast("date").alias("metric_date"),
        F.hour(stamp).alias("metric_hour"),
        "metric_name",
        "value_min",
        "value_max",
        "value_sum",
        F.try_divide("value_sum", "value_count").alias(MEAN),
        *extra,
    ).where(F.col("resource").isNotNull() & F.col("account_id").isNotNull())


_PLAIN = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min}


def _of_metric(metric: str, column: Column) -> Column:
    return F.when(F.col("metric_name") == metric, column)


def _resource_days(records: DataFrame, spec: MetricSpec, spread: bool) -> DataFrame:
    """One row per resource, account and day that has *every* metric.

    The day's percentiles are part of the one aggregate, unless ``spread``.
    """
    plain = [m for m in spec.measures if m.how in _PLAIN]
    ranked: dict[tuple[str, str, str], list[Measure]] = {}
    for m in spec.measures:
        if m.how not in _PLAIN:
            ranked.setdefault((m.how, m.metric, m.field), []).append(m)
    within = {key: group for key, group in ranked.items() if key[0] == "percentile" and not spread}
    aggregates = [_PLAIN[m.how](_of_metric(m.metric, F.col(m.field))).alias(m.name) for m in plain]
    for i, ((_, metric, field), group) in enumerate(within.items()):
        values = _of_metric(metric, F.col(field))
        aggregates.append(F.percentile(values, percentile_array([m.p for m in group])).alias(f"_p_{i}"))
    present = {f"_has_{i}": _of_metric(metric, F.lit(True)) for i, metric in enumerate(spec.metrics)}
    days = records.groupBy(*RESOURCE_DAY).agg(*aggregates, *[F.max(c).alias(n) for n, c in present.items()])
    for name in present:
        days = days.where(F.col(name))
    for i, group in enumerate(within.values()):
        days = days.withColumns({m.name: F.element_at(f"_p_{i}", j + 1) for j, m in enumerate(group)})
    days = days.drop(*present, *[f"_p_{i}" for i in range(len(within))])
    for (how, metric, field), group in ranked.items():
        if (how, metric, field) not in within:
            rows = records.where(F.col("metric_name") == metric)
            days = days.join(_percentile_columns(rows, group, how, spread), list(RESOURCE_DAY), "left")
    return days


def _percentile_columns(rows: DataFrame, group: Sequence[Measure], how: str, spread: bool) -> DataFrame:
    hourly = how == "max_hourly_percentile"
    keys = [*RESOURCE_DAY, "metric_hour"] if hourly else list(RESOURCE_DAY)
    field, probabilities = group[0].field, [m.p for m in group]
    if spread:
        found = exact_percentiles(rows, keys, field, probabilities)
    else:
        found = rows.groupBy(*keys).agg(F.percentile(field, percentile_array(probabilities)).alias("percentiles"))
    columns = {m.name: F.element_at("percentiles", i + 1) for i, m in enumerate(group)}
    if hourly:
        return found.groupBy(*RESOURCE_DAY).agg(*[F.max(c).alias(name) for name, c in columns.items()])
    return found.select(*RESOURCE_DAY, *[c.alias(name) for name, c in columns.items()])


def daily_usage(
    metrics: DataFrame,
    spec: MetricSpec,
    tag_map: DataFrame,
    *,
    days: Iterable[dt.date] | None = None,
    account: str | None = None,
    spread: bool = False,
) -> DataFrame:
    """Usage fact of one service: one row per resource, account and day.

    A resource-day that lacks one of the spec's metrics, and a resource
    without tags, is left out. ``days`` may be one day, or a whole range for a
    backfill: it is one plan either way. ``account`` limits the tag map before
    its newest row per resource is taken.

    All daily measures are one aggregate over one scan; only the hourly
    percentiles are a second one, joined on the same keys. A group is one
    resource's day or hour, which bounds it. For records without such a bound
    ``spread`` ranks values over all tasks instead (see ``percentiles``); the
    results are the same.
    """
    chosen = metrics if days is None else _on_days(metrics, days)
    return tagged_usage(_resource_days(metric_values(chosen, spec), spec, spread), spec, tag_map, account)


def tagged_usage(usage: DataFrame, spec: MetricSpec, tag_map: DataFrame, account: str | None = None) -> DataFrame:
    """Usage of resource-days with the calendar and the tag key of each resource; those without tags are left out."""
    tags = current_tag_map(tag_map, account)
    tagged = usage.join(
        tags,
        (usage["resource"] == tags["line_item_resource_id"]) & (usage["account_id"] == tags["line_item_usage_account_id"]),
    )
    calendar = calendar_columns(F.col("metric_date"))
    return tagged.select(
        "resource",
        F.col("account_id").alias("aws_account_dim_id"),
        *[m.name for m in spec.measures],
        date_dim_id(F.col("metric_date")).alias("date_dim_id"),
        "tag_dim_id",
        *[column.alias(name) for name, column in calendar.items()],
    )


def normalize_metrics(raw: DataFrame) -> DataFrame:
    """Landed metric records with calendar columns and a path-safe namespace.

    Works on batch and streaming frames. The calendar is that of the record's
    own timestamp.
    """
    stamp = epoch_millis_to_timestamp(F.col("timestamp"))
    return raw.withColumns(
        {
            "namespace": F.replace(F.col("namespace"), F.lit("/"), F.lit("")),
            **calendar_columns(stamp),
            "hour": F.hour(stamp),
        }
    )
