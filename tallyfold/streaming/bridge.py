"""The resource-to-tags bridge, kept current batch by batch.

The newest line of every resource is stored. A batch of new lines is reduced to
its own newest lines and merged with the stored ones, so old lines are never
read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyfold.operators.latest import bridge_rows, merge_newest, newest_lines
from tallyfold.session import delete_folder

VERSION = "batch-"


def _versions(spark: SparkSession, state: str) -> list[int]:
    """Numbers of the batches whose state was written to its end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(state)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{state.rstrip('/')}/{VERSION}*/_SUCCESS"))
    return sorted(int(status.getPath().getParent().getName().removeprefix(VERSION)) for status in done or ())


def _folder(state: str, number: int) -> str:
    return f"{state.rstrip('/')}/{VERSION}{number:012d}"


def refresh_bridge(
    new_lines: DataFrame, tag_cols: Sequence[str], state: str, checkpoint: str, *, tie_break: Sequence[Column]
) -> StreamingQuery:
    """Merge a stream of billing lines into the newest lines stored below ``state``.

    A folder of state belongs to one checkpoint. Each batch writes a version of
    its own from the version before it, so a batch that is repeated after a
    failure gives the same rows; the last two versions are kept for that.
    Lines may arrive in any order and more than once.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = newest_lines(batch, tag_cols, tie_break=tie_break)
        earlier = [n for n in _versions(spark, state) if n < number]
        if earlier:
            newest = merge_newest(spark.read.parquet(_folder(state, earlier[-1])), newest)
        newest.write.mode("overwrite").parquet(_folder(state, number))
        for old in earlier[:-1]:
            delete_folder(spark, _folder(state, old))

    return (
        new_lines.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_bridge(
    spark: SparkSession, state: str, tag_cols: Sequence[str], *, period: tuple[int, int] | None = None
) -> DataFrame:
    """The bridge as of the last batch; ``period`` as in ``latest_tags``."""
    return bridge_rows(spark.read.parquet(_folder(state, _versions(spark, state)[-1])), tag_cols, period=period)
