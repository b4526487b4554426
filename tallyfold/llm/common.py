"""Small helpers shared by the operators."""

from __future__ import annotations

import contextlib
import ctypes
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def group_count(rows: DataFrame, size: Column, target: int) -> int:
    """How many groups hold about ``target`` units each, one per shuffle task at least.

    One aggregate over the column; a single number reaches the driver.
    """
    total = rows.agg(F.sum(size)).first()[0] or 0
    return max(shuffle_partitions(rows.sparkSession), math.ceil(total / target))


def map_rows(rows: DataFrame, function: Callable[[dict], Iterator[dict]], schema: str) -> DataFrame:
    """Apply ``function`` to the column lists of every Arrow batch.

    It gets a batch as {column: list} and yields such batches. Arrow keeps
    64-bit integers exact beside nulls.
    """
    target = _arrow_schema(rows.sparkSession, schema)

    def run(batches):
        for batch in batches:
            for columns in function(batch.to_pydict()):
                yield pa.RecordBatch.from_pydict(columns, schema=target)

    return rows.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined, in the order given."""
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
    )


def one_blas_thread() -> None:
    """Let numpy's products in this worker use one thread; Spark runs a task per core already.

    Small products gain nothing from a second thread, and waiting for it costs
    as much processor time again. Without a known library nothing happens.
    """
    with contextlib.suppress(OSError), open("/proc/self/maps") as maps:
        for path in {line.split()[-1] for line in maps if "openblas" in line}:
            library = ctypes.CDLL(path)
            for name in ("openblas_set_num_threads", "scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_"):
                if hasattr(library, name):
                    getattr(library, name)(ctypes.c_int(1))
