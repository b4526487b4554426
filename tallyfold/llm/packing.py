"""Packing token sequences: first-fit decreasing within randomised groups.

Documents are dealt into groups by a hash. Each group tokenises its texts, cuts
what is longer than a sequence, and puts the pieces, longest first, into the
first bin with room, found in a tournament tree of bin capacities. Then the
gaps left are filled with cuts of the emptiest bins, and the one bin that stays
partly filled is cut into powers of two, which need no padding. Where the order of
rows matters, groups are ranges of it instead, and sequences are numbered along it.
"""

from __future__ import annotations

import os
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import group_count

PIECES = (
    "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)
CACHED_WORDS = 1_000_000
BATCH_WORDS = 4_096


class WordIds(dict):
    """Token ids of words as little-endian 32-bit bytes.

    White space always ends a token of this kind of vocabulary, so a text's ids
    are those of its words in order. New words are encoded together, set apart by
    a special token. Past ``limit`` words the table starts anew.
    """

    def __init__(self, tokenizer_path: str, limit: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.limit = Tokenizer.from_file(tokenizer_path), limit
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.border_id, self.border = special[0] if special else (None, None)

    @staticmethod
    def _stem(word: bytes) -> bytes:
        """The word without a mark after ASCII letters; the mark is a token of its own."""
        return word[:-1] if word[-1:] in (b",", b".") and word[:-1].isalpha() else word

    def _encode(self, words: list[bytes]) -> None:
        for at in range(0, len(words), BATCH_WORDS):
            part = words[at : at + BATCH_WORDS]
            if self.border:
                text = self.border.join([w.decode() for w in part])
                found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
                ids = np.array(found.ids, "<u4")
                cut = np.flatnonzero(ids == self.border_id)
                if len(cut) == len(part) - 1:  # no word holds the border itself
                    data, starts = ids.tobytes(), [0, *(cut + 1).tolist()]
                    for word, a, b in zip(part, starts, [*cut.tolist(), len(ids)]):
                        self[word] = data[4 * a : 4 * b]
                    continue
            for word in part:
                ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
                self[word] = np.array(ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        return self[self._stem(word)] + self[word[-1:]]

    def of(self, texts: list[str]) -> list[bytes]:
        """Ids of every text."""
        split = []
        for text in texts:
            data = text.encode()
            # Special tokens are told by case; all else is lower-cased anyway.
            split.append((data if b"<|" in data else data.lower()).split())
        needed = {b",", b"."}
        needed.update(*split)
        needed = set(map(self._stem, needed))
        if len(self) + len(needed) > self.limit:
            new = needed.difference(self)
            if len(self) + len(new) > self.limit:
                self.clear()
        self._encode(sorted(needed.difference(self)))
        return [b"".join(map(self.__getitem__, words)) for words in split]


def word_ids(tokenizer_path: str) -> WordIds:
    """This worker process's table, kept from task to task."""
    store = sys.modules.setdefault("packing_word_ids", types.ModuleType("packing_word_ids"))
    tables = store.__dict__.setdefault("tables", {})
    if tokenizer_path not in tables:
        tables[tokenizer_path] = WordIds(tokenizer_path)
    return tables[tokenizer_path]


class TournamentTree:
    """Room left in each bin at the leaves; each inner node knows the most below it."""

    def __init__(self, bins: int, capacity: int):
        self.size = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.size)

    def place(self, length: int) -> int:
        """Take ``length`` from the first bin that has the room; its number."""
        room, node = self.room, 1
        while node < self.size:
            node *= 2
            if room[node] < length:
                node += 1
        bin_number = node - self.size
        room[node] -= length
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return bin_number


def pack_lengths(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) pieces that hold every token once.

    Each has ``capacity`` tokens, but for at most one per power of two below it.
    """
    bins: list[list[tuple[int, int, int]]] = []
    rest = []
    for document, length in enumerate(lengths):
        whole = length - length % capacity
        bins += [[(document, at, capacity)] for at in range(0, whole, capacity)]
        if length > whole:
            rest.append((document, whole, length - whole))
    rest.sort(key=lambda piece: (-piece[2], piece[0]))
    tree, filled = TournamentTree(len(rest), capacity), []
    for piece in rest:
        at = tree.place(piece[2])
        if at == len(filled):
            filled.append([])
        filled[at].append(piece)
    return bins + _fill_gaps(filled, capacity)


def _fill_gaps(filled: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Fill the gaps of full bins from the emptiest; cut the last into powers of two."""
    filled = sorted(filled, key=lambda pieces: -sum(p[2] for p in pieces))
    low, high = 0, len(filled) - 1
    while low < high:
        gap = capacity - sum(p[2] for p in filled[low])
        while gap and low < high:
            document, start, length = filled[high].pop()
            take = min(gap, length)
            filled[low].append((document, start + length - take, take))
            if take < length:
                filled[high].append((document, start, length - take))
            elif not filled[high]:
                high -= 1
            gap -= take
        if not gap:
            low += 1
    done, tail = filled[:low], [p for pieces in filled[low : high + 1] for p in pieces]
    left = sum(p[2] for p in tail)
    while left:
        want, pieces = 1 << (left.bit_length() - 1), []
        left -= want
        while want:
            document, start, length = tail.pop()
            take = min(want, length)
            pieces.append((document, start, take))
            if take < length:
                tail.append((document, start + take, length - take))
            want -= take
        done.append(pieces)
    return done


def in_file_order(documents: DataFrame) -> DataFrame:
    """Adds ``file`` and ``row``, by which the rows have the order they are stored in.

    Rows of files are placed by the number in the file's name and their place in
    the file; others by partition and place, which must not change between reads.
    """
    try:
        stored = documents.select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        at = F.monotonically_increasing_id()
        return documents.withColumn("row", at).select(
            *documents.columns, F.shiftright("row", 33).cast("string").alias("file"), "row"
        )
    # Part numbers have five digits or more.
    number = F.lpad(F.regexp_extract("file_name", r"^part-(\d+)", 1), 12, "0")
    return stored.select(*documents.columns, F.concat(number, F.lit("/"), "file_name").alias("file"), "row")


def _ranges(rows: DataFrame, groups: int) -> DataFrame:
    """Adds ``grp``: ranges along ``file`` and ``row`` of about equal size, with the columns ``text``."""
    size = F.coalesce(F.length("text"), F.lit(0)).cast("bigint") + 1
    sizes = rows.groupBy("file").agg(F.sum(size).alias("size"))  # one row per file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "file",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
        F.sum("size").over(Window.partitionBy()).alias("total"),
    )
    running = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("start") + F.coalesce(F.sum(size).over(running), F.lit(0))
    return rows.join(F.broadcast(starts), "file").withColumn(
        "grp", F.floor(offset * F.lit(float(groups)) / F.col("total")).cast("int")
    )


def along(sequences: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Sequences by the mean place of their tokens' documents."""
    return sorted(sequences, key=lambda pieces: sum(d * n for d, _, n in pieces) / sum(n for _, _, n in pieces))


def pack_documents(
    documents: DataFrame,
    id_column: str,
    text_column: str,
    tokenizer_path: str,
    end_id: int = 2,
    capacity: int = 4096,
    group_chars: int = 4_000_000,
    seed: int = 0,
    ordered: bool = False,
) -> DataFrame:
    """Pack the tokens of every document into sequences of ``capacity``.

    Returns one row per piece: ``id_column``, ``start`` (its document's tokens
    before it), ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and
    ``offset``. A document is its ids and ``end_id``; a null or empty text is
    ``end_id`` alone. Every row is packed: repeated rows and null ids too; an
    empty table gives an empty result; other columns are ignored. ``capacity``
    is a power of two. The groups are random (by ``seed``) and bounded by
    ``group_chars`` to the nearest document. ``tokenizer_path`` must exist on
    every executor and name a vocabulary whose tokens end at white space.

    With ``ordered`` the groups are ranges of the stored order of rows, and
    ``sequence_id`` follows it: by group, then by the mean place of a sequence's
    documents.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    text, ordinal = documents[text_column], F.monotonically_increasing_id()
    groups = group_count(documents, F.length(text), group_chars)
    if ordered:
        placed = in_file_order(documents.select(documents[id_column].cast("bigint").alias("id"), text.alias("text")))
        dealt = _ranges(placed, groups).select("grp", "id", "text", "file", "row")
    else:
        dealt = documents.select(
            # The ordinal parts rows that repeat whole.
            F.pmod(F.xxhash64(documents[id_column], text, F.lit(seed), ordinal), F.lit(groups)).cast("int").alias("grp"),
            documents[id_column].cast("bigint").alias("id"),
            text.alias("text"),
        )
    schema = pa.schema([(part.split(" ")[0], pa.int64()) for part in PIECES.split(", ")])
    end = np.array([end_id], "<u4").tobytes()

    def pack(key, table):
        ids_of = word_ids(tokenizer_path)
        if ordered:
            table = table.sort_by([("file", "ascending"), ("row", "ascending")])
        rows = list(zip(table.column("id").to_pylist(), table.column("text").to_pylist()))
        if not ordered:
            rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        tokens = [ids + end for ids in ids_of.of([text or "" for _, text in rows])]
        out = {name: [] for name in schema.names}
        sequences = pack_lengths([len(t) // 4 for t in tokens], capacity)
        for number, pieces in enumerate(along(sequences) if ordered else sequences):
            offset = 0
            for document, start, length in pieces:
                out["id"].append(rows[document][0])
                out["start"].append(start)
                out["length"].append(length)
                out["ids_crc32"].append(zlib.crc32(tokens[document][4 * start : 4 * (start + length)]))
                out["doc_tokens"].append(len(tokens[document]) // 4)
                out["sequence_id"].append((key[0].as_py() << 32) + number)
                out["offset"].append(offset)
                offset += length
        return pa.table(out, schema)

    return dealt.groupBy("grp").applyInArrow(pack, PIECES).withColumnRenamed("id", id_column)
