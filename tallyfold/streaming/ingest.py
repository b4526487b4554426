"""Metric ingest and usage refresh.

No operator keeps streaming state: a late record changes its own day, and that
day is recomputed and replaced.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyfold.operators.reshape import fit_types
from tallyfold.operators.usage import MetricSpec, daily_usage, normalize_metrics
from tallyfold.schemas import METRIC_BATCH, METRIC_SCHEMA, as_text
from tallyfold.session import delete_folder, shared_work_dir
from tallyfold.sources.readers import read_metric_days
from tallyfold.sources.writers import day_partitions, overwrite_partitions, write_metrics

DAY_PARTITIONS = ("year", "month", "day")
MISFITS = "misfits"


def metric_stream(
    spark: SparkSession, path: str, *, schema: T.StructType = METRIC_SCHEMA, files_per_batch: int | None = None
) -> DataFrame:
    """New metric files below ``path``. Which files were read is kept in the
    query's checkpoint. ``files_per_batch`` bounds a batch after a long gap.
    Numbers written as text count as numbers; values that fit no other way are
    kept in the column ``misfits``."""
    reader = spark.readStream.schema(as_text(schema)).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return fit_types(reader.json(path), schema, misfits=MISFITS)


def _unfit(columns: Sequence[str]) -> Column:
    """Whether a record cannot enter the metric table as it was sent."""
    lost = F.col(MISFITS).isNotNull() if MISFITS in columns else F.lit(False)
    # Without them a record has no folder.
    return lost | F.col("timestamp").isNull() | (F.coalesce("namespace", F.lit("")) == "")


def quarantine_path(path: str) -> str:
    return path.rstrip("/") + "-quarantine"


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Records kept out of the metric table at ``path``, by batch, with what was sent in ``misfits``."""
    return spark.read.parquet(quarantine_path(path))


def ingest_metrics(
    raw: DataFrame, path: str, checkpoint: str, *, seen: Callable[[dict[str, int | str]], None] | None = None
) -> StreamingQuery:
    """Add normalized records to the metric table; others go into quarantine.

    Processes everything that is there and stops. A batch writes partitions of
    its own, named after the checkpoint and the batch's number, so a restarted
    batch replaces what it wrote before. There is no sink log: what others
    write to the table is read as well.

    A record with a value of the wrong type, or without namespace or timestamp,
    is stored beside the table, whole and with the value as it was sent. The
    batch is computed once, into the work folder, and counted on the way;
    ``seen`` gets {batch, records, quarantined} of each.
    """
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def write(batch: DataFrame, number: int) -> None:
        spark, name = batch.sparkSession, f"{stream}-{number:08d}"
        rows = normalize_metrics(batch).withColumn("_unfit", _unfit(batch.columns))
        counts = Observation(name)
        staged = shared_work_dir(spark, "metric-batch")
        observed = rows.observe(counts, F.count(F.lit(1)).alias("records"), F.count_if("_unfit").alias("quarantined"))
        observed.write.parquet(staged)
        stored = spark.read.schema(rows.schema).parquet(staged)
        fit = stored.where("NOT _unfit").drop("_unfit", MISFITS)
        write_metrics(fit, path, batch=name, generation=number)
        kept = stored.where("_unfit").drop("_unfit").withColumn(METRIC_BATCH, F.lit(name))
        overwrite_partitions(kept, quarantine_path(path), [METRIC_BATCH])
        delete_folder(spark, staged)
        if seen is not None:
            seen({"batch": name, **counts.get})

    return (
        raw.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def touched_days(batch: DataFrame) -> list[dt.date]:
    """Days occurring in a batch. The list is as long as the calendar the
    batch covers, however many records it has."""
    rows = batch.select(*DAY_PARTITIONS).distinct().collect()
    return sorted(dt.date(r["year"], r["month"], r["day"]) for r in rows)


def refresh_usage(
    new_metrics: DataFrame,
    metrics_path: str,
    spec: MetricSpec,
    tag_map: DataFrame,
    output: str,
    checkpoint: str,
) -> StreamingQuery:
    """Keep one usage fact current: each batch of ingested metrics names the
    days to recompute from the full metric table, which are then replaced.

    ``new_metrics`` is a stream over the ingested table. Replaying a batch
    gives the same files.
    """
    spark = new_metrics.sparkSession

    def replace_days(batch: DataFrame, _batch_id: int) -> None:
        days = touched_days(batch.where(batch["namespace"] == spec.namespace))
        if days:
            metrics = read_metric_days(spark, metrics_path, spec.namespace, days)
            usage = daily_usage(metrics, spec, tag_map, days=days)
            overwrite_partitions(usage, output, DAY_PARTITIONS, expected=day_partitions(days))

    return (
        new_metrics.writeStream.foreachBatch(replace_days)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
