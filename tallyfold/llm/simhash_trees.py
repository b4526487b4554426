"""SimHash near-duplicates, paired by vantage-point trees.

Equal fingerprints are one point. Points are dealt into shards that overlap: one
per block of the fingerprint's bits, holding the points with the same bits there.
With more blocks than ``radius`` every pair within ``radius`` bits meets in a
shard (some block is free of differences), so none is missed. A shard is searched
by a vantage-point tree over all bits: distances to the vantage point split it at
the median, both halves receive what lies within ``radius`` of the border, and
the triangle bound drops the rest.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_rows, shuffle_partitions
from .components import connected_components
from .rolling import mixed

SEED = 42
LEAF = 1 << 16  # comparisons made at once at a leaf
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of every ``width``-word shingle, repeats included.

    Words are ASCII lower-cased and joined by one space; fewer words than
    ``width`` are one shingle; no words give none.
    """
    data = b" ".join((text or "").encode().lower().split())
    if not data:
        return np.zeros(0, "<u8")
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    start, stop = np.r_[0, gaps + 1], np.r_[gaps, len(data)]
    if len(start) > width:
        start, stop = start[: len(start) - width + 1], stop[width - 1 :]
    else:
        start, stop = start[:1], stop[-1:]
    of = xxhash.xxh64_intdigest
    return np.array([of(data[a:b], SEED) for a, b in zip(start.tolist(), stop.tolist())], "<u8")


def fingerprint(text: str | None, width: int, words: int = 1) -> bytes:
    """``words`` times 64 bits, each set where it is in over half of the hashes.

    The first 64 bits are of the shingles' own hashes, further ones of hashes
    mixed from them. A text without words has all bits zero.
    """
    return fingerprint_of(shingle_hashes(text, width), words)


def fingerprint_of(hashes: np.ndarray, words: int) -> bytes:
    """The fingerprint of shingle hashes, each counted as often as it stands there."""
    out = []
    for word in range(words):
        if word:
            hashes = mixed(hashes + np.uint64(0x9E3779B97F4A7C15)) if len(hashes) else hashes
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 14):
            part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(np.packbits((2 * ones > len(hashes))[::-1]).tobytes())
    return b"".join(out)


def fingerprints(documents: DataFrame, id_column: str, text_column: str, width: int, words: int) -> DataFrame:
    """(id, fp) of every row; one pass, no shuffle."""
    rows = documents.select(documents[id_column].cast("bigint").alias("id"), documents[text_column].alias("text"))

    def scan(batch: dict):
        yield {"id": batch["id"], "fp": [fingerprint(t, width, words) for t in batch["text"]]}

    return map_rows(rows, scan, "id bigint, fp binary")


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of points whose last axis holds their 64-bit words."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int32)


def near_links(points: np.ndarray, radius: int, residents: np.ndarray, visitors: np.ndarray):
    """Arrays (i, j) that link residents and visitors within ``radius``, or through others.

    A vantage-point tree of residents searched by all visitors from the top:
    visitors follow every branch the triangle bound leaves open. Where residents
    and visitors lie so near the vantage point that each pair must be within
    ``radius``, they are linked to it alone.
    """
    stack = [(residents, visitors)]
    while stack:
        residents, visitors = stack.pop()
        if not len(residents) or not len(visitors):
            continue
        if len(residents) * len(visitors) > LEAF:
            vantage = residents[0]
            near_r = _distances(points[residents], points[vantage])
            near_v = _distances(points[visitors], points[vantage])
            if int(near_r.max()) + int(near_v.max()) <= radius:
                yield np.full(len(residents) + len(visitors), vantage), np.r_[residents, visitors]
                continue
            cut = np.median(near_r)
            inside = near_r <= cut
            if inside.all():
                cut = int(near_r.max()) - 1
                inside = near_r <= cut
            if inside.any() and not inside.all():
                stack.append((residents[inside], visitors[near_v <= cut + radius]))
                stack.append((residents[~inside], visitors[near_v > cut - radius]))
                continue
        step = max(1, LEAF // len(visitors))
        for at in range(0, len(residents), step):
            part = residents[at : at + step]
            i, j = np.nonzero(_distances(points[part][:, None], points[visitors][None]) <= radius)
            yield part[i], visitors[j]


def spanning_links(n: int, links) -> list[tuple[int, int]]:
    """A forest that connects what the links connect: fewer than ``n`` of them."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for left, right in links:
        for i, j in zip(left.tolist(), right.tolist()):
            if i != j:
                a, b = root(i), root(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    kept.append((i, j))
    return kept


def similar_points(points: DataFrame, radius: int, words: int, blocks: int, shard_rows: int) -> DataFrame:
    """Links (a, b) between ids that connect all points (id, fp) within ``radius`` bits.

    Links reach what all pairs that share a block would; each task returns a
    forest of them. A shard beyond ``shard_rows`` is cut into parts, and each pair
    of parts is a task's.
    """
    spark = points.sparkSession
    cuts = [64 * words * k // blocks for k in range(blocks + 1)]

    def deal(batch: dict):
        fps = batch["fp"]
        bits = np.unpackbits(np.frombuffer(b"".join(fps), np.uint8).reshape(len(fps), -1), axis=1, bitorder="little")
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            value = bits[:, a:b].astype(np.int64) @ (1 << np.arange(b - a, dtype=np.int64))
            yield {"id": batch["id"], "fp": fps, "block": [k] * len(fps), "value": value.tolist()}

    dealt = map_rows(points, deal, "id bigint, fp binary, block int, value bigint")
    large = (
        dealt.groupBy("block", "value")
        .agg(F.count("*").alias("rows"))
        .where(F.col("rows") > shard_rows)
        .select("block", "value", F.ceil(F.col("rows") / shard_rows).cast("int").alias("parts"))
    )
    # Many small shards share a task, which holds about as many points as a large shard.
    tasks = max(4 * shuffle_partitions(spark), math.ceil(points.count() * blocks / shard_rows))
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda p: F.struct(F.least(p, F.col("own")).alias("r"), F.greatest(p, F.col("own")).alias("v")),
    )
    tasked = (
        dealt.join(large, ["block", "value"], "left")
        .withColumn("own", own)
        .withColumn("pair", F.explode(pairs))
        .select(
            "id", "fp", "block", "value", "own", F.col("pair.r").alias("r"), F.col("pair.v").alias("v"),
            F.pmod(F.xxhash64("block", "value", "pair"), F.lit(tasks)).cast("int").alias("task"),
        )
    )

    def search(key, table):
        fps = np.frombuffer(b"".join(table.column("fp").to_pylist()), "<u8").reshape(-1, words)
        ids, block, value, own, r, v = (
            table.column(c).to_numpy().astype(np.int64) for c in ("id", "block", "value", "own", "r", "v")
        )
        order = np.lexsort((fps[:, 0], own, v, r, value, block))
        fps, ids, own, r, v = fps[order], ids[order], own[order], r[order], v[order]
        shard = np.stack((block[order], value[order], r, v))
        cut = np.flatnonzero((shard[:, 1:] != shard[:, :-1]).any(0)) + 1
        a, b = [], []
        for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(ids)]):
            if hi - lo > 1:
                every = np.arange(hi - lo)
                home, guest = every[own[lo:hi] == r[lo]], every[own[lo:hi] == v[lo]]
                for i, j in spanning_links(hi - lo, near_links(fps[lo:hi], radius, home, guest)):
                    a.append(ids[lo + i])
                    b.append(ids[lo + j])
        return pa.table({"a": np.array(a, np.int64), "b": np.array(b, np.int64)}, LINKS)

    return tasked.groupBy("task").applyInArrow(search, "a bigint, b bigint")


def simhash_groups(
    documents: DataFrame,
    id_column: str,
    text_column: str,
    width: int = 4,
    radius: int = 4,
    words: int = 1,
    blocks: int | None = None,
    shard_rows: int = 50_000,
) -> DataFrame:
    """Fingerprint and near-duplicate group of every document.

    Returns ``id_column``, ``fingerprint`` (16 lower-case hex digits for each of
    its ``words``) and ``component_id``, the smallest id reachable through
    fingerprints that differ in ``radius`` bits or fewer. With ``blocks`` of
    ``radius + 1`` (the default) or more every such pair is found; fewer make
    larger blocks, for wide radii, and find a pair with the chance that some block
    is free of differences.

    One row per input row; repeated rows and equal fingerprints are linked, and so
    are texts with the same smallest id; a null or empty text has fingerprint zero, linked
    like any other; a row with a null id takes the component of its equals, null
    where none has an id; an empty table gives an empty result; other columns are
    ignored. ``id_column`` holds 64-bit integers.
    """
    if not 0 <= radius < 64 * words:
        raise ValueError("radius must lie between 0 and the number of bits")
    blocks = blocks or radius + 1
    if math.ceil(64 * words / blocks) > 62:
        raise ValueError("a block holds at most 62 bits")
    marked = materialize(fingerprints(documents, id_column, text_column, width, words), "fingerprints")
    points = materialize(marked.groupBy("fp").agg(F.min("id").alias("id")), "points")
    links = similar_points(points.where("id IS NOT NULL"), radius, words, blocks, shard_rows)
    roots = connected_components(links)
    named = materialize(
        points.join(roots.withColumnRenamed("node", "id"), "id", "left").select(
            "fp", F.coalesce("root", "id").alias("component_id")
        ),
        "point-components",
    )
    return marked.join(named, "fp", "left").select(
        F.col("id").alias(id_column), F.lower(F.hex("fp")).alias("fingerprint"), "component_id"
    )
