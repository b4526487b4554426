"""Removal of repeated passages through fixed-block anchors.

A passage repeats when a window of ``width`` words also starts earlier in the
corpus. Every such window holds a whole block of ``width // 2`` words at a
multiple of that length, so those blocks, which do not overlap, are the index,
and every rolling window of a block's length is a probe:

1. Documents are dealt into groups of bounded size. A group sends each distinct
   probe, as 32 bits within its bucket of the hash space, marked where it is also
   an index block.
2. A bucket returns to each group the probes that meet an index block elsewhere.
   This only narrows the search; chance hits cost time, not results.
3. A group extends its hits: windows of full width around a hit block are sent
   with 96 bits of hash beside the bucket, and their earliest place in the group.
4. A bucket finds the earliest place of each window and returns the late ones.
5. A group marks every word of its late windows. Overlapping windows make the
   maximal repeats.

Equal windows of a group travel once, so a passage found in a third of all
documents costs one entry per group, not one per document or pair.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import group_count
from .rolling import BASES, window_hashes, word_hashes

NO_ID = np.iinfo(np.int64).max  # a null id stands behind all others


def _pack(values: np.ndarray) -> bytes:
    """Bytes of an array by significance, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=values.dtype.type(0)))


def _unpack_sorted(data: bytes, kind: str) -> np.ndarray:
    return np.cumsum(_unpack(data, kind), dtype=kind)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _slices(bucket: np.ndarray):
    """(bucket, slice) of each run of a sorted array."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(bucket)]):
        if b > a:
            yield int(bucket[a]), slice(a, b)


class Group:
    """The documents of a group in order, and the place of each of their words."""

    def __init__(self, table: pa.Table, bases: tuple[int, ...]):
        ids = [NO_ID if i is None else i for i in table.column("id").to_pylist()]
        texts = [(t or "").encode() for t in table.column("text").to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.texts = [texts[i] for i in order]
        self.words, self.counts = word_hashes(self.texts, bases)
        self.first = np.cumsum(self.counts) - self.counts
        self.document = np.repeat(np.arange(len(self.ids)), self.counts)
        self.place = np.arange(len(self.document)) - self.first[self.document]

    def windows(self, width: int, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows that lie within a document, and their hashes."""
        hashes = window_hashes(self.words[base], width, BASES[base])
        inside = np.flatnonzero(self.document[: len(hashes)] == self.document[len(self.document) - len(hashes) :])
        return inside, hashes[inside]


def _probes(group: Group, block: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    start, hashes = group.windows(block)
    return start, (_bucket(hashes, buckets) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


PROBES = "bucket int, grp int, plain binary, plain_again binary, anchor binary, anchor_again binary"
HITS = "grp int, bucket int, hits binary"
WINDOWS = "bucket int, grp int, h binary, g binary, id binary, start binary"
LATE = "grp int, h binary, g binary"
RESULT = "id bigint, n_words bigint, n_removed bigint, kept_text_sha256 string, removed array<struct<start:bigint,stop:bigint>>"


def repeated_passages(documents: DataFrame, id_column: str, text_column: str, width: int = 20, group_chars: int = 8_000_000) -> DataFrame:
    """Words removed from each document as repeats of earlier text.

    Returns ``id_column``, ``n_words``, ``n_removed``, ``kept_text_sha256`` (kept
    words joined by a space) and ``removed``, the spans of removed words, stop
    exclusive. Earlier is a smaller id, or an earlier start in the same document;
    documents with the same id go by text, and identical rows in any order; null
    ids come last. One row per input row; a null or empty text has no words; an
    empty table gives an empty result; other columns are ignored. ``id_column``
    holds 64-bit integers. ``group_chars`` bounds a task's group, to the nearest
    document. Windows are equal when 96 bits of their hashes and the bucket are.
    """
    if width < 2:
        raise ValueError("width must be at least 2")
    block = width // 2
    spark = documents.sparkSession
    text = documents[text_column]
    groups = group_count(documents, F.length(text), group_chars)
    dealt = documents.select(
        F.pmod(F.xxhash64(documents[id_column], text), F.lit(groups)).cast("int").alias("grp"),
        documents[id_column].cast("bigint").alias("id"),
        text.alias("text"),
    )
    first, both = BASES[:1], BASES

    def send_probes(key, table):
        group = Group(table, first)
        start, codes = _probes(group, block, groups)
        anchored = np.unique(codes[group.place[start] % block == 0])
        codes, count = np.unique(codes, return_counts=True)
        kind = 2 * np.isin(codes, anchored, assume_unique=True) + (count > 1)
        out = {name: [] for name in ("bucket", "grp", "plain", "plain_again", "anchor", "anchor_again")}
        for bucket, part in _slices(codes >> np.uint64(32)):
            low, of = codes[part].astype(np.uint32), kind[part]
            out["bucket"].append(bucket)
            out["grp"].append(key[0].as_py())
            for k, name in enumerate(("plain", "plain_again", "anchor", "anchor_again")):
                out[name].append(_pack_sorted(low[of == k]))
        return pa.table(out, _schema(PROBES))

    def find_hits(key, table):
        codes, kinds, owner = [], [], []
        for row in table.to_pylist():
            for k, name in enumerate(("plain", "plain_again", "anchor", "anchor_again")):
                values = _unpack_sorted(row[name], "<u4")
                codes.append(values)
                kinds.append(np.full(len(values), k, np.uint8))
                owner.append(np.full(len(values), row["grp"], np.int32))
        codes, kinds, owner = map(np.concatenate, (codes, kinds, owner))
        order = np.argsort(codes, kind="stable")
        codes, kinds, owner = codes[order], kinds[order], owner[order]
        runs = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        size = np.diff(np.r_[runs, len(codes)])
        seen = np.bitwise_or.reduceat(kinds, runs)
        hit = np.repeat((seen >= 2) & ((size > 1) | (seen & 1 == 1)), size)
        codes, owner = codes[hit], owner[hit]
        order = np.lexsort((codes, owner))
        codes, owner = codes[order], owner[order]
        rows = [(g, _pack_sorted(codes[part])) for g, part in _slices(owner)]
        bucket = [key[0].as_py()] * len(rows)
        return pa.table({"grp": [r[0] for r in rows], "bucket": bucket, "hits": [r[1] for r in rows]}, _schema(HITS))

    def extend_hits(key, table, hits):
        empty = pa.table({name: [] for name in ("bucket", "grp", "h", "g", "id", "start")}, _schema(WINDOWS))
        if not table.num_rows or not hits.num_rows:
            return empty
        group = Group(table, both)
        start, codes = _probes(group, block, groups)
        wanted = np.sort(
            np.concatenate(
                [
                    _unpack_sorted(r["hits"], "<u4").astype(np.uint64) | np.uint64(r["bucket"] << 32)
                    for r in hits.to_pylist()
                ]
            )
        )
        hit = np.zeros(len(group.document) + width, bool)
        hit[start] = wanted[np.minimum(np.searchsorted(wanted, codes), len(wanted) - 1)] == codes
        start, h = group.windows(width)
        # A window that repeats has its own first block at a multiple among the hits.
        near = hit[start + (-group.place[start]) % block]
        start, h = start[near], h[near]
        g = window_hashes(group.words[1], width, BASES[1])[start].astype(np.uint32)
        lead = _earliest(h, g)
        start, h, g = start[lead], h[lead], g[lead]
        order = np.argsort(_bucket(h, groups), kind="stable")  # by place within a bucket
        start, h, g = start[order], h[order], g[order]
        out = {name: [] for name in ("bucket", "grp", "h", "g", "id", "start")}
        for bucket, part in _slices(_bucket(h, groups)):
            out["bucket"].append(bucket)
            out["grp"].append(key[0].as_py())
            out["h"].append(_pack(h[part]))
            out["g"].append(_pack(g[part]))
            out["id"].append(_pack(np.diff(group.ids[group.document[start[part]]], prepend=0)))
            out["start"].append(_pack(np.diff(group.place[start[part]].astype(np.int32), prepend=np.int32(0))))
        return pa.table(out, _schema(WINDOWS))

    def find_late(key, table):
        h, g, ids, starts, owner = [], [], [], [], []
        for row in table.to_pylist():
            h.append(_unpack(row["h"], "<u8"))
            g.append(_unpack(row["g"], "<u4"))
            ids.append(np.cumsum(_unpack(row["id"], "<i8")))
            starts.append(np.cumsum(_unpack(row["start"], "<i4"), dtype=np.int32))
            owner.append(np.full(len(h[-1]), row["grp"], np.int32))
        h, g, ids, starts, owner = map(np.concatenate, (h, g, ids, starts, owner))
        order = np.lexsort((owner, starts, ids, g, h))
        h, g, owner = h[order], g[order], owner[order]
        late = np.r_[False, (h[1:] == h[:-1]) & (g[1:] == g[:-1])]
        h, g, owner = h[late], g[late], owner[late]
        order = np.argsort(owner, kind="stable")
        h, g, owner = h[order], g[order], owner[order]
        rows = [(k, _pack(h[part]), _pack(g[part])) for k, part in _slices(owner)]
        return pa.table({"grp": [r[0] for r in rows], "h": [r[1] for r in rows], "g": [r[2] for r in rows]}, _schema(LATE))

    def remove_late(key, table, late):
        if not table.num_rows:
            return pa.table({n: [] for n in ("id", "n_words", "n_removed", "kept_text_sha256", "removed")}, _schema(RESULT))
        group = Group(table, both)
        start, h = group.windows(width)
        g = window_hashes(group.words[1], width, BASES[1])[start].astype(np.uint32)
        repeat = np.ones(len(start), bool)
        repeat[_earliest(h, g)] = False
        if late.num_rows:
            rows = late.to_pylist()
            late_h = np.concatenate([_unpack(r["h"], "<u8") for r in rows])
            late_g = np.concatenate([_unpack(r["g"], "<u4") for r in rows])
            # Every occurrence of a late window in the group is late.
            among = np.concatenate((np.zeros(len(h), bool), np.ones(len(late_h), bool)))
            all_h, all_g = np.concatenate((h, late_h)), np.concatenate((g, late_g))
            order = np.lexsort((all_g, all_h))
            all_h, all_g, among = all_h[order], all_g[order], among[order]
            runs = np.flatnonzero(np.r_[True, (all_h[1:] != all_h[:-1]) | (all_g[1:] != all_g[:-1])])
            named = np.repeat(np.logical_or.reduceat(among, runs), np.diff(np.r_[runs, len(among)]))
            marked = np.zeros(len(among), bool)
            marked[order] = named
            repeat |= marked[: len(h)]
        change = np.zeros(len(group.document) + 1, np.int64)
        change[start[repeat]] += 1
        np.subtract.at(change, start[repeat] + width, 1)
        gone = np.cumsum(change[:-1]) > 0
        out = {n: [] for n in ("id", "n_words", "n_removed", "kept_text_sha256", "removed")}
        for i, data in enumerate(group.texts):
            mask = gone[group.first[i] : group.first[i] + group.counts[i]]
            words = data.split()
            edge = np.flatnonzero(np.diff(np.r_[False, mask, False])).tolist()
            kept = compress(words, (~mask).tolist()) if edge else words
            out["id"].append(None if group.ids[i] == NO_ID else int(group.ids[i]))
            out["n_words"].append(len(words))
            out["n_removed"].append(int(mask.sum()))
            out["kept_text_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            out["removed"].append([{"start": a, "stop": b} for a, b in zip(edge[::2], edge[1::2])])
        return pa.table(out, _schema(RESULT))

    texts = lambda: dealt.groupBy("grp")  # noqa: E731  one exchange of the texts, read three times
    probes = texts().applyInArrow(send_probes, PROBES)
    hits = probes.groupBy("bucket").applyInArrow(find_hits, HITS)
    windows = texts().cogroup(hits.groupBy("grp")).applyInArrow(extend_hits, WINDOWS)
    late = windows.groupBy("bucket").applyInArrow(find_late, LATE)
    result = texts().cogroup(late.groupBy("grp")).applyInArrow(remove_late, RESULT)
    return result.withColumnRenamed("id", id_column)


def _earliest(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Places of the first occurrence of every (h, g), in order."""
    order = np.lexsort((g, h))
    new = np.r_[True, (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])] if len(h) else np.zeros(0, bool)
    return np.sort(order[new])


def _schema(text: str) -> pa.Schema:
    kinds = {
        "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(),
        "array<struct<start:bigint,stop:bigint>>": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split(" ") for part in text.split(", "))])
