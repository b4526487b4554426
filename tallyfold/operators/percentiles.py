"""Exact interpolated percentiles without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.session import materialize


def percentile_array(probabilities: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(p)) for p in probabilities])


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    *,
    output: str = "percentiles",
) -> DataFrame:
    """``percentile(value, probabilities)`` per key as an array column.

    ``percentile`` holds every distinct value of a group in one task, which
    suits groups of bounded size. Here a group may be any share of the data:

    1. Equal values are counted; the shuffle key includes the value, so one key
       spreads over all tasks.
    2. The counts are sorted by key and value into ranges of equal size and
       stored with the number of their range, whatever the distribution.
    3. Totals per key and range, as many as a key has ranges, tell which range
       holds a wanted rank and how many rows lie before it. Only those ranges are
       read again, and a running sum within each finds the value.

    Null keys form a group, as they do for ``percentile``. Null values are
    ignored. Equal neighbours of a rank
    are returned as they are, so infinities do not become NaN.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    counted = rows.groupBy(*keys, "_x").agg(F.count("*").alias("_c"))
    ranged = counted.repartitionByRange(*keys, "_x").withColumn("_range", F.spark_partition_id())
    values = materialize(ranged, "values")

    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = values.groupBy(*keys, "_range").agg(F.sum("_c").alias("_n"))
    placed = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    placed = placed.withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
    positions = [F.lit(float(p)) * (F.col("_total") - 1) for p in probabilities]
    ranks = F.array_distinct(F.array(*[f(p).cast("long") for p in positions for f in (F.floor, F.ceil)]))
    here = F.filter(ranks, lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_n")))
    wanted = placed.select(*keys, "_range", "_start", "_total", here.alias("_ranks")).where(F.size("_ranks") > 0)

    running = Window.partitionBy(*keys, "_range").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    theirs = [f"_w{i}" for i in range(len(keys) + 1)]
    wanted = wanted.withColumnsRenamed(dict(zip([*keys, "_range"], theirs)))
    same = [values[mine].eqNullSafe(F.col(name)) for mine, name in zip([*keys, "_range"], theirs)]
    found = (
        values.join(wanted, reduce(and_, same)).drop(*theirs)
        .withColumn("_from", F.col("_start") + F.coalesce(F.sum("_c").over(running), F.lit(0)))
        .select(
            *keys, "_total", "_x",
            F.filter("_ranks", lambda r: (r >= F.col("_from")) & (r < F.col("_from") + F.col("_c"))).alias("_ranks"),
        )
        .where(F.size("_ranks") > 0)
        .select(*keys, "_total", F.explode("_ranks").alias("_rank"), "_x")
    )

    def at(rank: Column) -> Column:
        return F.max(F.when(F.col("_rank") == rank.cast("long"), F.col("_x")))

    picks = []
    for i, position in enumerate(positions):
        picks += [at(F.floor(position)).alias(f"_low_{i}"), at(F.ceil(position)).alias(f"_high_{i}")]
    bounds = found.groupBy(*keys, "_total").agg(*picks)

    def between(i: int) -> Column:
        low, high, position = F.col(f"_low_{i}"), F.col(f"_high_{i}"), positions[i]
        mixed = low * (F.ceil(position) - position) + high * (position - F.floor(position))
        return F.when(low == high, low).otherwise(mixed)

    return bounds.select(*keys, F.array(*[between(i) for i in range(len(positions))]).alias(output))
