"""Mixing sources to target weights by Pfair scheduling, in SQL expressions only.

Each source's documents form a stream of blocks of about ``block_chars``
characters. With weight w, block i of a source (from 0) may start at floor(i / w)
and must be placed by ceil((i + 1) / w), in slots of one block. Serving the
released block with the earliest deadline keeps every source within one block of
its share at every slot. Weights are whole parts of a period, so the schedule
repeats: one period is worked out, and block i's slot follows from it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NO_SOURCE = "none"


def period_parts(weights: DataFrame, period: int) -> DataFrame:
    """(key, parts, period): whole parts of a period of ``period`` slots.

    Every source has a part; the rest goes by weight, left-over parts to the
    largest remainders, ties by key. The period is twice the number of sources
    where that is more. ``weights`` has ``key`` and a bigint ``weight`` of 1 or more.
    """
    every = Window.partitionBy()
    counted = weights.select(
        "key",
        F.col("weight").cast("decimal(38,0)").alias("weight"),
        F.sum("weight").over(every).cast("decimal(38,0)").alias("total"),
        F.count("*").over(every).alias("n"),
    ).withColumn("period", F.greatest(F.lit(period).cast("bigint"), 2 * F.col("n")))
    free = F.col("period") - F.col("n")
    shared = counted.select(
        "key", "period", free.alias("free"),
        F.expr("(period - n) * weight div total").cast("bigint").alias("whole"),
        F.expr("(period - n) * weight % total").alias("left"),
    )
    place = F.row_number().over(Window.partitionBy().orderBy(F.desc("left"), "key"))
    spare = F.col("free") - F.sum("whole").over(every)
    return shared.select(
        "key", "period", (1 + F.col("whole") + F.when(place <= spare, 1).otherwise(0)).cast("bigint").alias("parts")
    )


def earliest_deadline_first(parts: Column, period: Column) -> Column:
    """For each slot of a period the place, in the array ``parts``, of the source served.

    A source with p parts has its c-th block (from 0) released at slot
    floor(c * period / p), with the deadline ceil((c + 1) * period / p).
    """
    start = F.struct(
        F.transform(parts, lambda p: F.lit(0).cast("bigint")).alias("served"),
        F.array().cast("array<int>").alias("slots"),
    )

    def serve(state: Column, slot: Column) -> Column:
        released = F.transform(
            F.arrays_zip(parts.alias("p"), state["served"].alias("c")),
            lambda s, k: F.when(
                F.floor(s["c"] * period / s["p"]) <= slot,
                F.struct(F.ceil((s["c"] + 1) * period / s["p"]).alias("deadline"), k.alias("k")),
            ),
        )
        return F.aggregate(
            F.array(F.array_min(released)["k"]),
            state,
            lambda old, k: F.struct(
                F.transform(old["served"], lambda c, j: F.when(j == k, c + 1).otherwise(c)).alias("served"),
                F.concat(old["slots"], F.array(k)).alias("slots"),
            ),
        )

    return F.aggregate(F.sequence(F.lit(0).cast("bigint"), period - 1), start, serve, lambda state: state["slots"])


def mix_sources(
    documents: DataFrame,
    id_column: str,
    text_column: str,
    source_column: str,
    keep: list[str] | None = None,
    weights: dict[str, int] | None = None,
    period: int = 1_000,
    block_chars: int = 65_536,
    seed: int = 0,
) -> DataFrame:
    """Every document's block and slot in a mixture of sources with target weights.

    Returns ``id_column``, the columns of ``keep``, ``mix_source`` (the source, or
    ``none``), ``block`` (of its source, from 0), ``slot``, and ``place`` (its
    order within the slot). Read by (slot, place), each source stays within one
    block of its share until the first source ends; then the others go on in the
    same proportions, and nothing is dropped. The schedule of one period is worked
    out in one row: its cost grows with the square of the number of sources, to
    about 20 s at 2,000. ``weights`` gives whole weights by
    source, 1 for those it lacks; by default a source's weight is the root of its
    characters, which lifts small sources. Order within a source is by a hash of
    the id, or of the text where that is null.

    One row per input row: repeated rows, null ids, null sources (one source,
    ``none``), null and empty texts (one character) stay; an empty table gives an
    empty result; other columns are ignored.
    """
    keep = [c for c in (keep or []) if c != id_column]
    names = [f"kept_{i}" for i in range(len(keep) + 1)]
    columns = [documents[c] for c in [id_column, *keep]]
    text = documents[text_column]
    # Rows without an id are told apart by their text.
    name = F.coalesce(documents[id_column].cast("string"), F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))
    identity = F.concat_ws(":", name, F.lit(str(seed)))
    rows = math.ceil(math.sqrt(documents.count())) or 1
    # A source is cut into about as many pieces as a piece has rows, so that
    # neither a piece's running sum nor the sum over pieces is one large task.
    placed = documents.select(
        *[c.alias(n) for c, n in zip(columns, names)],
        F.coalesce(documents[source_column].cast("string"), F.lit(NO_SOURCE)).alias("key"),
        F.greatest(F.length(F.coalesce(text, F.lit(""))), F.lit(1)).cast("bigint").alias("size"),
        F.md5(identity).alias("place"),
    ).withColumn("piece", (F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint") % rows).cast("int"))
    pieces = placed.groupBy("key", "piece").agg(F.sum("size").alias("size"))
    before = Window.partitionBy("key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.groupBy("key").agg(F.sum("size").alias("weight"))
    if weights is None:
        weight = F.greatest(F.floor(F.sqrt("weight")), F.lit(1))
    else:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else None
        weight = F.coalesce(given[F.col("key")], F.lit(1)) if weights else F.lit(1)
    parts = period_parts(sizes.select("key", weight.cast("bigint").alias("weight")), period)
    plan = (
        parts.groupBy("period")
        .agg(F.sort_array(F.collect_list(F.struct("key", "parts"))).alias("sources"))
        .withColumn("slots", earliest_deadline_first(F.col("sources.parts"), F.col("period")))
        .select("period", "sources", F.posexplode("slots").alias("slot", "k"))
        .groupBy("period", "k", F.element_at("sources", F.col("k") + 1).alias("source"))
        .agg(F.sort_array(F.collect_list("slot")).alias("slots"))
        .select(F.col("source.key").alias("key"), "period", "slots")
    )
    started = pieces.select("key", "piece", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    running = Window.partitionBy("key", "piece").orderBy("place", *names[:1], "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offset = F.col("start") + F.coalesce(F.sum("size").over(running), F.lit(0))
    block = F.floor(offset / block_chars)
    turn = F.size("slots")
    return (
        placed.join(started.join(plan, "key"), ["key", "piece"])
        .withColumn("block", block.cast("bigint"))
        .select(
            *[F.col(n).alias(c) for n, c in zip(names, [id_column, *keep])],
            F.col("key").alias("mix_source"),
            "block",
            (F.floor(F.col("block") / turn) * F.col("period") + F.get("slots", (F.col("block") % turn).cast("int")))
            .cast("bigint")
            .alias("slot"),
            "place",
        )
    )
