"""Rows in the order of their group, without holding a group in one task."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import _arrow_schema

PART_BITS = 33  # of monotonically_increasing_id: below them a row's number in its partition


def placed(rows: DataFrame, group: str, order: list[str | Column]) -> DataFrame:
    """The rows with a unique bigint ``place`` that ascends by group, then by ``order``; nulls first.

    Sorted by range, so a group that holds a third of the rows is spread over many
    tasks; only rows equal in the whole order stay together. The result is stored,
    so places do not change when a task runs again.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    return materialize(ranged.withColumn("place", F.monotonically_increasing_id()), "placed")


def positions(rows: DataFrame, group: str) -> DataFrame:
    """Placed rows with the bigint ``pos``, 0 for the first row of each group. Null is no group.

    A group's rows in one partition have consecutive places, so a position is the
    distance to the first of them plus the group's rows in earlier partitions.
    """
    part = F.shiftright("place", PART_BITS).alias("part")
    runs = rows.groupBy(group, part).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")
    runs = runs.select(group, "part", shift.alias("shift"))
    numbered = rows.withColumn("part", part).join(runs, [group, "part"])
    return numbered.withColumn("pos", F.col("place") + F.col("shift")).drop("part", "shift")


def joined_sha256(rows: DataFrame, group: str, order: list[str], line: str, separator: str) -> DataFrame:
    """(group, sha256) of each group's lines in order, with ``separator`` between them.

    SHA-256 reads its input from front to back, so a group's lines pass one task;
    it streams over sorted batches and holds one batch and one state.
    """
    kind = dict(rows.dtypes)[group]
    schema = f"{group} {kind}, sha256 string"
    target = _arrow_schema(rows.sparkSession, schema)
    mark = separator.encode()

    def run(batches):
        state, current = None, None
        for batch in batches:
            keys, hashes = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is None or key != current:
                    if state is not None:
                        keys.append(current)
                        hashes.append(state.hexdigest())
                    state, current = hashlib.sha256(), key
                else:
                    state.update(mark)
                state.update(text.encode())
            yield pa.RecordBatch.from_pydict({group: keys, "sha256": hashes}, schema=target)
        if state is not None:
            yield pa.RecordBatch.from_pydict({group: [current], "sha256": [state.hexdigest()]}, schema=target)

    lined = rows.select(group, line, *order).repartition(F.col(group)).sortWithinPartitions(group, *order)
    return lined.select(group, line).mapInArrow(run, schema)
