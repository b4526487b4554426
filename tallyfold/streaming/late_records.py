"""Usage kept current by what changed in the metric table.

The metric table's writer records which records a batch added, replaced or
repeated; counts of values take those changes up, and only the resource-days they
touch are worked out again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyfold.functions.calendar import calendar_columns
from tallyfold.operators.usage import RESOURCE_DAY, MetricSpec
from tallyfold.operators.value_counts import folded, merged, unfolded, usage_of_counts, value_counts
from tallyfold.schemas import METRIC_BATCH, METRIC_PARTITIONS, METRIC_RECORD
from tallyfold.session import delete_folder, materialize
from tallyfold.sources.readers import named_folders, one_generation, read_folders
from tallyfold.sources.writers import overwrite_partitions, with_generation, write_metrics

DAYS = ("year", "month", "day")
SIGN = "sign"
APPLIED = "applied"


def changes_path(path: str) -> str:
    return path.rstrip("/") + "-changes"


def _days(rows: DataFrame) -> list[dict[str, object]]:
    """As many as the calendar that the rows cover has days."""
    return [r.asDict() for r in rows.select(*DAYS).distinct().collect()]


def write_with_changes(df: DataFrame, path: str, batch: str, generation: int) -> None:
    """``write_metrics``, and beside the table the records it adds (sign 1) and replaces (sign -1).

    Only the touched hours are read, and of them only records that the batch
    brings again. A batch that is repeated leaves its changes as they are, so
    readers that took them up do not see them twice: a name stands for the same
    records for good, and a correction takes a new one. One writer at a time.
    """
    spark = df.sparkSession
    if named_folders(spark, changes_path(path), [{METRIC_BATCH: batch}]):
        write_metrics(df, path, batch=batch, generation=generation)
        return
    rows = materialize(with_generation(df, batch, generation), "metric-batch")
    hours = [r.asDict() for r in rows.select(*METRIC_PARTITIONS).distinct().collect()]
    after = rows
    signed = lambda records, sign: records.withColumn(SIGN, F.lit(sign).cast("bigint"))
    changes = signed(one_generation(after), 1)
    if hours and named_folders(spark, path, hours):
        stored = read_folders(spark, path, hours).where(F.col(METRIC_BATCH) != batch)
        record = [c for c in METRIC_RECORD if c in rows.columns]
        brought = rows.select(*[F.col(c).alias(f"_{c}") for c in record])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in record]
        known = stored.join(brought, same, "left_semi")
        now = one_generation(known.select(*rows.columns).unionByName(rows))
        before = one_generation(known).select(*now.columns)
        changes = signed(now, 1).unionByName(signed(before, -1))
    named = changes.withColumn(METRIC_BATCH, F.lit(batch))
    overwrite_partitions(named, changes_path(path), [METRIC_BATCH])
    write_metrics(df, path, batch=batch, generation=generation)


def refresh_by_changes(
    changes: DataFrame, spec: MetricSpec, tag_map: DataFrame, state: str, output: str, checkpoint: str
) -> StreamingQuery:
    """Keep counts below ``state`` and the usage fact at ``output`` current with a stream of changes.

    Counts are stored by day with the number of the batch that they include, so a
    batch repeated after a failure is not added again. A batch reads the counts of
    the days it touches and rewrites them; usage is worked out for its
    resource-days alone, and the other rows of those days stay.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        chosen = batch.where(F.col("namespace") == spec.namespace)
        new = value_counts(chosen, spec).withColumns(calendar_columns(F.col("metric_date")))
        new = materialize(new, "value-changes")
        days = _days(new)
        if not days:
            return
        counts = [new]
        if named_folders(spark, state, days):
            stored = read_folders(spark, state, days)
            # Days that already include this batch keep their counts.
            done = stored.groupBy(*DAYS).agg(F.max(APPLIED).alias(APPLIED)).where(F.col(APPLIED) >= number).select(*DAYS)
            counts = [new.join(F.broadcast(done), list(DAYS), "left_anti"), unfolded(stored)]
        total = materialize(merged(counts), "value-counts")
        kept = folded(total).withColumns({**calendar_columns(F.col("metric_date")), APPLIED: F.lit(number).cast("bigint")})
        overwrite_partitions(kept, state, DAYS)
        touched = new.select(*RESOURCE_DAY).distinct()
        usage = usage_of_counts(total.join(touched, list(RESOURCE_DAY), "left_semi"), spec, tag_map)
        if named_folders(spark, output, days):
            gone = touched.select(
                F.col("resource"), F.col("account_id").alias("aws_account_dim_id"), F.date_format("metric_date", "yyyyMMdd").alias("date_dim_id")
            )
            others = read_folders(spark, output, days).join(gone, ["resource", "aws_account_dim_id", "date_dim_id"], "left_anti")
            usage = others.select(*usage.columns).unionByName(usage)
        # Rows of the output cannot replace the files that they are read from.
        usage = materialize(usage, "usage-days")
        overwrite_partitions(usage, output, DAYS, expected=days)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def forget_changes(spark: SparkSession, path: str, batches: Sequence[str]) -> None:
    """Delete the changes of batches that every reader has taken up."""
    for batch in batches:
        delete_folder(spark, f"{changes_path(path)}/{METRIC_BATCH}={batch}")
