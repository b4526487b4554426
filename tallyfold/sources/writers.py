"""Sinks.

Partitioned writes are rebalanced on the partition columns: adaptive
execution splits a partition holding much of the data over several tasks and
merges small ones, so a hot day neither stalls one task nor leaves thousands
of small files.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.operators.latest import latest_per
from tallyfold.operators.upsert import unstaged, upsert
from tallyfold.schemas import METRIC_BATCH, METRIC_GENERATION, METRIC_PARTITIONS, METRIC_RECORD
from tallyfold.session import delete_folder, many_small_files, released_shuffles, shared_work_dir

# Replays come after any micro-batch; a correction of a replay passes more.
REPLAY_GENERATION = 1 << 40


def spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of one partition together, large partitions split."""
    return df.hint("rebalance", *columns)


def _files(spark: SparkSession, folder: str) -> set[str]:
    """Names of the files of one folder; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {status.getPath().getName() for status in system.listStatus(path)} if system.exists(path) else set()


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    *,
    sort_by: Sequence[str] = (),
    expected: Iterable[dict[str, object]] = (),
    dealt: bool = False,
) -> None:
    """Replace the partitions that occur in ``df``, and empty those of
    ``expected`` that do not; rerunning gives the same table. Sorting rows
    within each file lets later filters on ``sort_by`` skip row groups.

    ``expected`` names partitions by their values, such as the days a
    recomputation covers. A folder of theirs that holds the same files after
    the write as before has no rows in ``df``: its old rows go.
    ``dealt`` says that the rows of a partition already lie in few tasks, so
    they are not shuffled for the write.
    """
    spark = df.sparkSession
    # As many folders as the caller expects partitions.
    folders = ["/".join([path.rstrip("/"), *[f"{p}={e[p]}" for p in partitions]]) for e in expected]
    before = {folder: _files(spark, folder) for folder in folders}
    rows = df if dealt else spread(df, partitions)
    if sort_by:
        rows = rows.sortWithinPartitions(*partitions, *sort_by)
    # Dealt rows of a folder lie in several tasks, so more tasks would be more files.
    with released_shuffles(spark), contextlib.nullcontext() if dealt else many_small_files(spark):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions)
            .parquet(path)
        )
    for folder, files in before.items():
        if files and files == _files(spark, folder):
            delete_folder(spark, folder)


def day_partitions(days: Iterable[dt.date]) -> list[dict[str, object]]:
    """Partition values of whole days, as ``expected`` takes them."""
    return [{"year": d.year, "month": d.month, "day": d.day} for d in days]


def append_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Add rows. A rerun adds them again: prefer ``overwrite_partitions``."""
    spread(df, partitions).write.mode("append").partitionBy(*partitions).parquet(path)


def one_delivery(df: DataFrame) -> DataFrame:
    """Each metric record once, however often the frame holds it.

    Of deliveries that differ the one with the largest values stays, which is
    arbitrary but the same in every run.
    """
    record = [c for c in METRIC_RECORD if c in df.columns]
    others = [c for c in df.columns if c not in record]
    return latest_per(df, record, [F.struct(*others).desc()] if others else [F.lit(0)])


def with_generation(df: DataFrame, batch: str, generation: int) -> DataFrame:
    """A batch's records as the metric table holds them."""
    return one_delivery(df).withColumns({METRIC_GENERATION: F.lit(generation).cast("bigint"), METRIC_BATCH: F.lit(batch)})


def write_metrics(df: DataFrame, path: str, batch: str = "replay", generation: int = REPLAY_GENERATION) -> None:
    """Metric table by namespace and hour, and by the batch that brought the records.

    A stream and replays share one table: each replaces only the touched hours
    of its own ``batch``, so repeating either changes nothing. Where batches
    hold the same record, readers take that of the newest ``generation``; a
    record delivered twice within the batch is written once.
    """
    overwrite_partitions(with_generation(df, batch, generation), path, (*METRIC_PARTITIONS, METRIC_BATCH))


def replace_table(df: DataFrame, path: str) -> None:
    """Truncate and load. ``df`` must not read ``path``."""
    with released_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def swap_table(df: DataFrame, name: str, root: str) -> str:
    """Write a new version next to the old, then point the table at it.

    The columns may change. Readers see the old files until the table is
    re-created over the new folder, whose path is returned.
    """
    spark = df.sparkSession
    location = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(location)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=location, source="parquet")
    return location


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """Create or replace a view from a query over tables and views; it reads them whenever it is read."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {query}")


def write_if_any(df: DataFrame, write) -> bool:
    """Call ``write(df)`` unless ``df`` has no rows; tells whether it did."""
    if df.isEmpty():
        return False
    write(df)
    return True


def load(df: DataFrame, path: str, mode: str) -> bool:
    """Dimension load by mode: ``full`` replaces, ``month`` and ``delta`` add
    the rows there are."""
    if mode == "full":
        replace_table(df, path)
        return True
    if mode in ("month", "delta"):
        return write_if_any(df, lambda rows: rows.write.mode("append").parquet(path))
    raise ValueError(f"mode: {mode!r}")


def upsert_partitions(
    spark: SparkSession,
    path: str,
    stage: DataFrame,
    keys: Sequence[str],
    partitions: Sequence[str],
    *,
    dealt: bool = False,
) -> None:
    """Keyed upsert into a partitioned table whose partitions follow from the
    key (a day column): only the staged partitions are read and rewritten.

    The stage is computed once, into the shared work folder. Its partition
    values prune the target by a join. The target's rows that stay go to the work
    folder too, because a path cannot be overwritten while it is read; the last step
    replaces the partitions by them and the staged rows and can be repeated. Then
    both are deleted. ``dealt`` says that the staged rows of a partition already lie
    in few tasks: they are not shuffled for the write, and rows that stay are where they are stored.
    """
    staged, kept = shared_work_dir(spark, "upsert-stage"), shared_work_dir(spark, "upsert")
    with released_shuffles(spark):
        stage.write.parquet(staged)
    rows = spark.read.schema(stage.schema).parquet(staged)
    target = spark.read.parquet(path).join(rows.select(*partitions).distinct(), list(partitions), "left_semi")
    others = unstaged(target.select(*stage.columns), rows, keys)
    with released_shuffles(spark):
        (spread(others, partitions) if dealt else others).write.parquet(kept)
    whole = spark.read.schema(stage.schema).parquet(kept).unionByName(rows)
    overwrite_partitions(whole, path, partitions, dealt=dealt)
    for folder in (staged, kept):
        delete_folder(spark, folder)


def upsert_table(spark: SparkSession, path: str, stage: DataFrame, keys: Sequence[str]) -> None:
    """Keyed upsert into a table without partitions, which is rewritten."""
    staged, merged = shared_work_dir(spark, "upsert-stage"), shared_work_dir(spark, "upsert")
    with released_shuffles(spark):
        stage.write.parquet(staged)
    rows = spark.read.schema(stage.schema).parquet(staged)
    with released_shuffles(spark):
        upsert(spark.read.parquet(path), rows, keys).write.parquet(merged)
    replace_table(spark.read.parquet(merged), path)
    for folder in (staged, merged):
        delete_folder(spark, folder)


def row_counts(**frames: DataFrame) -> DataFrame:
    """Row count per named frame, as one small frame (for quality reports)."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("frame"), "rows") for name, df in frames.items()]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts
