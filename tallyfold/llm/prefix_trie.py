"""Conversation prefix trie on minimal-perfect-hash node tables.

A node is a distinct prefix of turns, named by its depth and 128 bits: the XOR of
its turns' hashes, each taken with its position, which splits a conversation of any
length into chunks. Chunks are dealt into shards of bounded size. A shard
enumerates its distinct prefixes, gives each a slot by a minimal perfect hash,
checks the digest in the slot, scatters counts into flat arrays, and accumulates
them through parent slots, deepest first. All that is counted is a sum over
conversations, so the shards' nodes add up to the whole trie's.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import _arrow_schema, group_count
from .ordered import joined_sha256, placed, positions

CHUNK_BITS = 10  # turns of one chunk share the higher bits of their position
SHARD_TURNS = 200_000
ID_BITS = 10  # conversation ids hashed together
HUBS = 1_000
NOTHING = hashlib.sha256().hexdigest()


class MinimalPerfectHash:
    """Slots 0..n-1 of n distinct pairs of 64-bit keys.

    At each level the keys that are alone in their cell take its rank as their
    slot; the others go on to the next, smaller level.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[np.ndarray] = []
        taken = 0
        while len(a):
            cell = self._cells(a, b, len(self.levels), 2 * len(a))
            alone = np.bincount(cell, minlength=2 * len(a)) == 1
            slots = np.where(alone, taken + np.cumsum(alone) - 1, -1)
            self.levels.append(slots)
            taken += int(alone.sum())
            a, b = a[~alone[cell]], b[~alone[cell]]

    @staticmethod
    def _cells(a, b, level: int, size: int) -> np.ndarray:
        x = (a ^ np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= (b + np.uint64(level)) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        return (x % np.uint64(size)).astype(np.int64)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = np.full(len(a), -1, np.int64)
        open_rows = np.arange(len(a))
        for level, slots in enumerate(self.levels):
            cell = self._cells(a[open_rows], b[open_rows], level, len(slots))
            found[open_rows] = slots[cell]
            open_rows = open_rows[found[open_rows] < 0]
        return found


class NodeTable(NamedTuple):
    """A shard's nodes; arrays by row of the shard, or by slot."""

    slot: np.ndarray  # of each row
    previous: np.ndarray  # the slot of the row before in the chunk, -1 for its first row
    first_row: np.ndarray  # of each slot; rows ascend by conversation
    parent: np.ndarray  # slot of each slot, -1 where it lies in an earlier chunk


class Shard:
    """Chunks of conversations, their turns laid end to end in the order of conversations."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks().sort_by([("conv", "ascending"), ("chunk", "ascending")])
        column = lambda name: table.column(name).to_numpy(zero_copy_only=False)
        items = table.column("items").combine_chunks()
        items = items.chunk(0) if isinstance(items, pa.ChunkedArray) else items
        sizes = items.value_lengths().to_numpy(zero_copy_only=False)
        turns = items.flatten()
        field = lambda name: turns.field(name).to_numpy(zero_copy_only=False)
        self.start = np.cumsum(sizes) - sizes
        self.end = self.start + sizes - 1
        self.depth, self.bytes, self.turn = field("pos") + 1, field("bytes"), turns.field("turn")
        self.conv = np.repeat(column("conv"), sizes)
        self.table, self.sizes = table, sizes
        self.a, self.pa = self._prefixes(field("a"), column("before_a"))
        self.b, self.pb = self._prefixes(field("b"), column("before_b"))

    def _prefixes(self, hashes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Digests of each row's prefix and of the prefix one shorter."""
        total = np.bitwise_xor.accumulate(hashes.view(np.uint64))
        ahead = np.concatenate([[np.uint64(0)], total[:-1]])
        shift = np.repeat(before.view(np.uint64) ^ ahead[self.start], self.sizes)
        return total ^ shift, ahead ^ shift

    def column(self, name: str) -> np.ndarray:
        return self.table.column(name).to_numpy(zero_copy_only=False)

    def nodes(self) -> NodeTable:
        order = np.lexsort((self.b, self.a))
        a, b = self.a[order], self.b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        n = int(new.sum())
        slot = MinimalPerfectHash(a[new], b[new]).slots(self.a, self.b)
        first_row = np.full(n, -1, np.int64)
        rows = np.arange(len(slot))[::-1]
        first_row[slot[rows]] = rows
        if (self.a[first_row[slot]] != self.a).any() or (self.b[first_row[slot]] != self.b).any():
            raise ValueError("two prefixes share a slot")
        previous = np.concatenate([[-1], slot[:-1]])
        previous[self.start] = -1
        return NodeTable(slot, previous, first_row, previous[first_row])


SEEN = "a bigint, b bigint, depth bigint, pa bigint, pb bigint, turn binary, bytes bigint, conv bigint, n_convs bigint, n_ends bigint"
SUMS = "a bigint, b bigint, depth bigint, n_leaves bigint, saved_tokens bigint"


def _counted(table: pa.Table, target: pa.Schema) -> pa.Table:
    """Members and ends of a shard's nodes."""
    shard = Shard(table)
    nodes = shard.nodes()
    n, row = len(nodes.first_row), nodes.first_row
    ends = nodes.slot[shard.end[shard.column("is_last")]]
    signed = lambda x: x[row].view(np.int64)
    return pa.Table.from_arrays(
        [
            signed(shard.a), signed(shard.b), shard.depth[row], signed(shard.pa), signed(shard.pb),
            shard.turn.take(pa.array(row)), shard.bytes[row], shard.conv[row],
            np.bincount(nodes.slot, minlength=n), np.bincount(ends, minlength=n),
        ],
        schema=target,
    )


def _summed(table: pa.Table, target: pa.Schema) -> pa.Table:
    """Leaves below and bytes saved below a shard's nodes, by its conversations."""
    shard = Shard(table)
    nodes = shard.nodes()
    leaves, saved = np.zeros((2, len(nodes.first_row)), np.int64)
    own_from = np.repeat(shard.column("own_from"), shard.sizes)
    np.add.at(saved, nodes.slot, np.where(shard.depth < own_from, shard.bytes, 0))
    last = nodes.slot[shard.end]
    np.add.at(saved, last, shard.column("saved_later"))
    np.add.at(leaves, last, shard.column("leaf"))
    depth = shard.depth[nodes.first_row]
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[nodes.parent[level] >= 0]
        np.add.at(saved, nodes.parent[level], saved[level])
        np.add.at(leaves, nodes.parent[level], leaves[level])
    row = nodes.first_row
    return pa.Table.from_arrays(
        [shard.a[row].view(np.int64), shard.b[row].view(np.int64), depth, leaves, saved], schema=target
    )


def _by_shard(chunks: DataFrame, groups: int, function, schema: str) -> DataFrame:
    target = _arrow_schema(chunks.sparkSession, schema)
    # Conversations of neighbouring ids often share turns: they meet in one shard.
    near = F.xxhash64(F.shiftright("conv", ID_BITS), F.when(F.col("chunk") > 0, F.col("conv")), "chunk")
    dealt = chunks.withColumn("grp", F.pmod(near, F.lit(groups)))
    return dealt.groupBy("grp").applyInArrow(lambda table: function(table, target), schema)


def numbered_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, turn, bytes): each conversation's turns from 0, by digest and UTF-8 length of the text.

    In the order of ``turn``, nulls first; within a turn by role, then by the SHA-256 of
    the text. A null role or text is empty. Rows with a null conversation are in none.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in (role, text))
    digest = F.sha2(F.concat_ws(":", F.length(role), role, text), 256)
    light = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("t"), role.alias("role"),
        F.sha2(text, 256).alias("s"), F.substring(F.unhex(digest), 1, 16).alias("turn"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    return positions(placed(light, "conv", ["t", "role", "s"]), "conv").select("conv", "pos", "turn", "bytes")


def _chunks(turns: DataFrame) -> DataFrame:
    """Turns listed by conversation and chunk, with the digest of all before the chunk."""
    lane = lambda n: F.xxhash64(F.lit(n), "pos", "turn")
    items = F.sort_array(F.collect_list(F.struct("pos", "turn", "bytes", "a", "b")))
    chunks = (
        turns.select("*", lane(1).alias("a"), lane(2).alias("b"), F.shiftright("pos", CHUNK_BITS).alias("chunk"))
        .groupBy("conv", "chunk")
        .agg(items.alias("items"), F.expr("bit_xor(a)").alias("xor_a"), F.expr("bit_xor(b)").alias("xor_b"))
    )
    chunks = materialize(chunks, "trie-chunks")
    by_chunk = Window.partitionBy("conv").orderBy("chunk")
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    before = chunks.select(
        "conv", "chunk",
        *[F.coalesce(F.expr(f"bit_xor(xor_{x})").over(earlier), F.lit(0)).alias(f"before_{x}") for x in "ab"],
        F.lead("chunk").over(by_chunk).isNull().alias("is_last"),
    )
    return materialize(chunks.join(before, ["conv", "chunk"]), "trie-chunks")


def _nodes(chunks: DataFrame, groups: int) -> DataFrame:
    """Every node once; equal digests of unequal prefixes are an error."""
    same = (F.min(F.struct("pa", "pb", "turn")) == F.max(F.struct("pa", "pb", "turn"))).alias("same")
    nodes = (
        _by_shard(chunks, groups, _counted, SEEN)
        .groupBy("a", "b", "depth")
        .agg(
            F.min("conv").alias("conv_id"), F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.min("turn").alias("turn"),
            F.min("bytes").alias("bytes"), F.sum("n_convs").alias("n_convs"), F.sum("n_ends").alias("n_ends"), same,
        )
    )
    collision = F.raise_error(F.lit("two prefixes share a digest")).cast("boolean")
    return materialize(nodes.where(F.when(F.col("same"), True).otherwise(collision)).drop("same"), "trie-nodes")


def _sums(chunks: DataFrame, nodes: DataFrame, groups: int) -> DataFrame:
    """Leaves and saved bytes of every node's subtree.

    A node belongs to its smallest member, which owns its path from some depth to
    the end. Of a node's members all but the owner save its bytes; a leaf counts
    once, by its owner. So both sums over a subtree are sums over members of what
    lies on their own paths below.
    """
    owners = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("own_from"), F.max((F.col("n_convs") == F.col("n_ends")).cast("bigint")).alias("leaf")
    )
    owned = chunks.join(owners, F.col("conv") == F.col("conv_id"), "left").select(
        *chunks.columns,
        F.coalesce("own_from", F.lit(2**62)).alias("own_from"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"),
    )
    shared = F.filter("items", lambda t: t["pos"] + 1 < F.col("own_from"))
    later = Window.partitionBy("conv").orderBy("chunk").rowsBetween(1, Window.unboundedFollowing)
    saved = owned.select(
        "conv", "chunk", F.aggregate(shared, F.lit(0).cast("bigint"), lambda n, t: n + t["bytes"]).alias("saved")
    )
    saved = saved.select("conv", "chunk", F.coalesce(F.sum("saved").over(later), F.lit(0)).alias("saved_later"))
    sums = _by_shard(owned.join(saved, ["conv", "chunk"]), groups, _summed, SUMS)
    return sums.groupBy("a", "b", "depth").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )


def _node_key():
    return F.concat_ws(":", "a", "b", "depth").alias("node")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(node, sha256) of the ascending ids of the conversations that end at a node.

    Ids are sorted by range and joined by blocks of 1,024, so of a node where a third
    of all conversations end, only the blocks pass one task.
    """
    stored = placed(ends, "node", ["conv"])
    listed = F.sort_array(F.collect_list(F.struct("place", F.col("conv").cast("string").alias("id"))))
    blocks = stored.groupBy("node", F.shiftright("place", 10).alias("block")).agg(listed.alias("l"))
    blocks = blocks.select("node", F.col("l")[0]["place"].alias("first"), F.array_join("l.id", ",").alias("ids"))
    return joined_sha256(blocks, "node", ["first"], "ids", ",")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Nodes with ``n_children`` and ``parent_conv_id`` (null at depth 1).

    Parents with more than a thousandth of all children, a thousand at most, are
    broadcast; the others meet their children in a shuffle.
    """
    deeper = nodes.where("depth > 1")
    children = materialize(
        deeper.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"), (F.col("depth") - 1).alias("depth")).agg(
            F.count("*").alias("n_children")
        ),
        "trie-children",
    )
    many = F.lit((deeper.count() or 1) / HUBS)
    parents = children.join(nodes.select("a", "b", "depth", "conv_id"), ["a", "b", "depth"]).select(
        F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"), (F.col("n_children") > many).alias("is_hub"),
    )
    parents = materialize(parents, "trie-parents")
    hub = F.broadcast(parents.where("is_hub")).select("pa", "pb", "depth", F.col("parent_conv_id").alias("hub_conv_id"))
    keyed = nodes.join(hub, ["pa", "pb", "depth"], "left")
    # A hub's children, and those of the root, need no second lookup: each gets a key of its own.
    known = F.col("hub_conv_id").isNotNull() | (F.col("depth") == 1)
    keyed = keyed.withColumn("apart", F.when(known, F.xxhash64("a", "b")).otherwise(0))
    rest = parents.where("NOT is_hub").select("pa", "pb", "depth", "parent_conv_id", F.lit(0).cast("bigint").alias("apart"))
    found = keyed.join(rest, ["pa", "pb", "depth", "apart"], "left")
    found = found.withColumn("parent_conv_id", F.coalesce("hub_conv_id", "parent_conv_id")).drop("hub_conv_id", "apart")
    return found.join(children, ["a", "b", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of conversations, the empty one included.

    ``turns`` has bigint ``conv``, bigint ``pos`` without gaps from 0, binary ``turn``
    (a digest of all that tells turns apart) and bigint ``bytes``; ``conversations`` has
    ``conv``, also of those without turns. Returns conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_ends, n_children, n_leaves, saved_tokens, ends_sha256
    and turn (the last one's digest). Repeated ids count once; no conversations give
    no rows; the root has neither parent nor turn.

    Shards hold about 200,000 turns whatever the lengths or the sharing, and a hub
    leaves a shard once. The driver gets counts and the root's row.
    """
    everyone = conversations.select(F.col("conv").cast("bigint").alias("conv")).where("conv IS NOT NULL").distinct()
    chunks = _chunks(turns.select("conv", "pos", "turn", "bytes"))
    groups = group_count(chunks, F.size("items"), SHARD_TURNS)
    nodes = _nodes(chunks, groups)
    sums = materialize(_sums(chunks, nodes, groups), "trie-sums")

    last = chunks.where("is_last")
    end = lambda x: F.col(f"before_{x}").bitwiseXOR(F.col(f"xor_{x}")).alias(x)
    depth = (F.element_at("items", -1)["pos"] + 1).alias("depth")
    ends = last.select("conv", end("a"), end("b"), depth).select("conv", _node_key())
    none = everyone.join(last.select("conv"), "conv", "left_anti").select("conv", F.lit("root").alias("node"))
    hashes = materialize(_end_hashes(ends.union(none)), "trie-ends")

    smallest, members = everyone.agg(F.min("conv"), F.count("*")).first()
    tops = nodes.where("depth = 1").join(sums, ["a", "b", "depth"])
    tops = tops.agg(F.count("*"), F.sum("n_leaves"), F.sum("saved_tokens"), F.sum("n_convs")).first()
    turnless = hashes.where("node = 'root'").first()
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_ends", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    of_root = (
        smallest, 0, None, members, members - (tops[3] or 0), tops[0], tops[1] or 1, tops[2] or 0,
        turnless["sha256"] if turnless else NOTHING, None,
    )
    schema = ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'bigint'}" for c in columns) + ", turn binary"
    root = turns.sparkSession.createDataFrame([of_root] if members else [], schema)

    below = _with_parents(nodes).join(sums, ["a", "b", "depth"]).withColumn("node", _node_key())
    below = below.join(hashes, "node", "left")
    parent = F.when(F.col("depth") == 1, F.lit(smallest)).otherwise(F.col("parent_conv_id")).cast("bigint")
    below = below.withColumn("parent_conv_id", parent)
    below = below.withColumn("ends_sha256", F.coalesce("sha256", F.lit(NOTHING))).select(*columns, "turn")
    return root.unionByName(below)
