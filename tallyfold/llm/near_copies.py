"""Near copies by the exact Jaccard similarity of their word shingles.

Fingerprints of distinct shingles, paired as in ``simhash_trees``, only propose:
their links give loose groups, within which every pair not linked yet is compared
by its whole sets of shingles, and only pairs that reach the threshold are linked.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_rows, shuffle_partitions
from .components import connected_components
from .simhash_trees import LINKS, fingerprint_of, shingle_hashes, similar_points


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles."""
    return np.unique(shingle_hashes(text, width))


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes()).digest()


def reaches(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets have a Jaccard similarity of ``percent`` / 100 or more; empty sets are equal."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * 100 >= percent * (len(a) + len(b) - both)


def confirmed_links(sets: list[np.ndarray], home: np.ndarray, guest: np.ndarray, percent: int):
    """Links (i, j) between home and guest that connect all their pairs that reach ``percent``.

    Pairs that earlier links connect are not compared again.
    """
    size = np.array([len(s) for s in sets])
    group = np.arange(len(sets))
    for i in np.flatnonzero(home):
        fits = (np.minimum(size, size[i]) * 100 >= percent * np.maximum(size, size[i])) & guest
        for j in np.flatnonzero(fits & (group != group[i])):
            if group[i] != group[j] and reaches(sets[i], sets[j], percent):
                group[group == group[j]] = group[i]
                yield i, j


def similar_groups(
    documents: DataFrame,
    id_column: str,
    text_column: str,
    width: int = 5,
    percent: int = 80,
    words: int = 6,
    radius: int = 80,
    blocks: int = 32,
    part_rows: int = 150,
    task_chars: int = 16_000_000,
) -> DataFrame:
    """The group of every document with an id.

    Returns ``id_column`` and ``component_id``, the smallest id reachable through
    pairs whose distinct ``width``-word shingles, told apart by a 64-bit hash, have
    a Jaccard similarity of ``percent`` / 100 or more. No pair below it is a link.
    A pair is found if its fingerprints or a chain of others connect it within
    ``radius`` bits. A loose group of g texts is compared in pairs of parts of
    ``part_rows`` or 4 * sqrt(g) texts, whichever is more, spread over tasks.

    One row per input row with an id; rows with the same id are linked, and texts
    without words are equal; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    rows = documents.select(documents[id_column].cast("bigint").alias("id"), documents[text_column].alias("text"))
    rows = rows.where("id IS NOT NULL")

    def mark(batch: dict):
        sets = [shingle_set(text, width) for text in batch["text"]]
        yield {"id": batch["id"], "key": list(map(set_key, sets)), "fp": [fingerprint_of(s, words) for s in sets]}

    marked = materialize(map_rows(rows, mark, "id bigint, key binary, fp binary"), "set-fingerprints")
    points = materialize(marked.groupBy("key").agg(F.min("id").alias("id"), F.first("fp").alias("fp")), "set-points")
    same = marked.join(points.select("key", F.col("id").alias("b")), "key").select(F.col("id").alias("a"), "b")
    # Equal fingerprints of unequal sets are one point of the search.
    least = points.groupBy("fp").agg(F.min("id").alias("id"))
    proposed = similar_points(least, radius, words, blocks, 50_000).union(
        points.join(least.withColumnRenamed("id", "b"), "fp").select(F.col("id").alias("a"), "b")
    )
    loose = materialize(connected_components(proposed), "loose-groups")
    members = points.select("id", "key").join(loose.withColumnRenamed("node", "id"), "id")
    sizes = members.groupBy("root").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.greatest(F.lit(part_rows), 4 * F.sqrt("n"))).cast("int")
    own = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda p: F.struct(F.least(p, F.col("own")).alias("r"), F.greatest(p, F.col("own")).alias("v")),
    )
    placed = members.join(sizes.select("root", parts.alias("parts")), "root").withColumn("own", own)
    texts = rows.withColumn("size", F.length("text"))
    compared = materialize(texts.join(placed, "id").select("id", "key", "text", "size", "root", "own", "parts"), "loose-texts")
    # Texts travel once for each pair of parts; tasks hold about ``task_chars`` of them.
    sent = compared.agg(F.sum(F.coalesce("size", F.lit(0)).cast("bigint") * F.col("parts"))).first()[0] or 0
    tasks = max(4 * shuffle_partitions(spark), math.ceil(sent / task_chars))
    tasked = (
        compared
        .withColumn("pair", F.explode(pairs))
        .select(
            "id", "key", "text", "root", "own", F.col("pair.r").alias("r"), F.col("pair.v").alias("v"),
            F.pmod(F.xxhash64("root", "pair"), F.lit(tasks)).cast("int").alias("task"),
        )
    )

    def confirm(key, table):
        columns = [table.column(c).to_pylist() for c in ("root", "r", "v", "key", "id", "own", "text")]
        groups: dict = {}
        for root, r, v, digest, node, part, text in zip(*columns):
            groups.setdefault((root, r, v), {}).setdefault((node, digest), (part, text))
        a, b = [], []
        for (_, r, v), found in groups.items():
            kept = []
            for (node, digest), (part, text) in sorted(found.items()):
                shingles = shingle_set(text, width)
                if set_key(shingles) == digest:  # not another text of the same id
                    kept.append((node, part, shingles))
            part = np.array([k[1] for k in kept], np.int64)
            for i, j in confirmed_links([k[2] for k in kept], part == r, part == v, percent):
                a.append(kept[i][0])
                b.append(kept[j][0])
        return pa.table({"a": np.array(a, np.int64), "b": np.array(b, np.int64)}, LINKS)

    links = tasked.groupBy("task").applyInArrow(confirm, "a bigint, b bigint")
    roots = materialize(connected_components(links.union(same)), "near-copies")
    return rows.select("id").join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("id").alias(id_column), F.coalesce("root", "id").alias("component_id")
    )
