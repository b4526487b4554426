"""Conversation structure repair by a grammar-compressed dynamic program.

A row is a symbol: its role's initial, whether it is cut short, or that it must go.
Rows are cut into chunks of at most 256 symbols. Re-Pair finds the pairs that
the distinct chunks of a group share and makes them rules. A symbol's transfer
matrix holds, for two states of the wanted structure, the cheapest edits between
them; a rule's matrix is the min-plus product of its two sides', worked out once,
with the edits as a rope over the sides' edits. Conversations then multiply the
matrices of their chunks.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import _arrow_schema, group_count
from .ordered import placed

CHUNK_BITS = 8  # rows of one chunk share the higher bits of their place
GROUP_SYMBOLS = 200_000
SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs

# States of (s?(ua)+)?: at the start, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ACCEPTED = (START, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}


def filled(state: int) -> int:
    """The state after a turn of the one role that an insertion or a new role may have here."""
    return STEP[state, "a" if state == USER else "u"]


class Rope(NamedTuple):
    """Text as the two texts it is joined from."""

    left: object
    right: object


def flat(rope) -> str:
    parts, todo = [], [rope]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            parts.append(node)
        else:
            todo += (node.right, node.left)
    return "".join(parts)


def least(a: list, b: list) -> bool:
    """Whether the ropes of ``a``, joined, come before those of ``b``; shared parts are not read."""
    x, y = a[::-1], b[::-1]
    while x and y:
        p, q = x.pop(), y.pop()
        if p is q:
            continue
        if not isinstance(p, str):
            x += (p.right, p.left)
            y.append(q)
        elif not isinstance(q, str):
            x.append(p)
            y += (q.right, q.left)
        else:
            n = min(len(p), len(q))
            if p[:n] != q[:n]:
                return p[:n] < q[:n]
            if len(p) > n:
                x.append(p[n:])
            if len(q) > n:
                y.append(q[n:])
    return not any(map(flat, x)) and any(map(flat, y))


def product(first: list, second: list) -> list:
    """Min-plus product: entry 4 * p + q is (cost, edits) of the cheapest way from p to q, or None.

    Of equal costs the least edits win. That choice holds in any context: edits
    that begin with others of the same ends insert more and cost more, so neither
    of two equally cheap ones is the beginning of the other.
    """
    result = [None] * 16
    for p in range(4):
        for q in range(4):
            best = None
            for k in range(4):
                a, b = first[4 * p + k], second[4 * k + q]
                if a is None or b is None:
                    continue
                cost = a[0] + b[0]
                if best is None or cost < best[0] or (cost == best[0] and least([a[1], b[1]], [best[1], best[2]])):
                    best = (cost, a[1], b[1])
            if best is not None:
                left, right = best[1], best[2]
                result[4 * p + q] = (best[0], Rope(left, right) if left and right else left or right)
    return result


def _insertions() -> list:
    matrix = [None] * 16
    for p in range(4):
        state, cost, edits = p, 0, ""
        while matrix[4 * p + state] is None:
            matrix[4 * p + state] = (cost, edits)
            state, cost, edits = filled(state), cost + INSERT, edits + "I"
    return matrix


INSERTIONS = _insertions()


def symbol_matrix(symbol: str) -> list:
    """Insertions, then one edit of a row: x must go; s, u, a, o is an initial; upper case: cut short."""
    matrix = [None] * 16
    extra = TRUNCATED if symbol.isupper() else 0
    for p in range(4):
        ways = [(p, DELETE, "D")]
        if symbol != "x":
            ways.append((filled(p), REROLE + extra, "R"))
            if (p, symbol.lower()) in STEP:
                ways.append((STEP[p, symbol.lower()], KEEP + extra, "K"))
        for q, cost, edit in ways:
            matrix[4 * p + q] = min(matrix[4 * p + q] or (cost, edit), (cost, edit))
    return product(INSERTIONS, matrix)


ALPHABET = "xsuaoSUAO"


def re_pair(words: list[str]) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Rules (left, right) and the words in symbols; rule r is symbol len(ALPHABET) + r.

    In each round the most frequent pairs that share no symbol become rules, until
    no pair occurs twice. A run of one symbol is paired from its front.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    text = np.full(int(lengths.sum()) + len(words), -1, np.int64)
    inside = np.ones(len(text), bool)
    inside[ends] = False
    code = np.zeros(128, np.int64)
    code[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
    text[inside] = code[np.frombuffer("".join(words).encode(), np.uint8)]
    rules: list[tuple[int, int]] = []
    while True:
        size = len(ALPHABET) + len(rules)
        pairs = np.where((text[:-1] >= 0) & (text[1:] >= 0), text[:-1] * size + text[1:], -1)
        found, counts = np.unique(pairs[pairs >= 0], return_counts=True)
        found, counts = found[counts > 1], counts[counts > 1]
        chosen, used = {}, set()
        for pair in found[np.lexsort((found, -counts))].tolist():
            left, right = divmod(pair, size)
            if left not in used and right not in used:
                used |= {left, right}
                chosen[pair] = (left, right)
        replaced = False
        for pair, sides in chosen.items():
            at = np.flatnonzero(pairs == pair)
            if sides[0] == sides[1]:  # of overlapping pairs every other one
                run = np.cumsum(np.diff(at, prepend=-2) > 1)
                first = np.flatnonzero(np.diff(run, prepend=0))
                at = at[(np.arange(len(at)) - first[run - 1]) % 2 == 0]
            if len(at) > 1:
                text[at] = len(ALPHABET) + len(rules)
                text[at + 1] = -2
                rules.append(sides)
                replaced = True
        if not replaced:
            break
        text = text[text != -2]
    ends = np.flatnonzero(text == -1)
    return rules, [part[part >= 0].tolist() for part in np.split(text, ends)[: len(words)]]


def chunk_matrices(words: list[str]) -> list[list]:
    """The transfer matrix of every word, through the rules the words share."""
    rules, packed = re_pair(words)
    matrices = [symbol_matrix(symbol) for symbol in ALPHABET]
    for left, right in rules:
        matrices.append(product(matrices[left], matrices[right]))
    results = []
    for word in packed:
        matrix = matrices[word[0]]
        for symbol in word[1:]:
            matrix = product(matrix, matrices[symbol])
        results.append(matrix)
    return results


MATRICES = "symbols string, costs array<int>, edits array<string>"
PIECES = (
    "conv bigint, first bigint, symbols string, state int, piece string, cost bigint, audit string, illegal bigint"
)


def _matrices(chunks: DataFrame) -> DataFrame:
    """The matrix of every distinct chunk, group by group."""
    target = _arrow_schema(chunks.sparkSession, MATRICES)

    def run(table: pa.Table) -> pa.Table:
        words = table.column("symbols").to_pylist()
        found = chunk_matrices(words)
        return pa.Table.from_pydict(
            {
                "symbols": words,
                "costs": [[e and e[0] for e in matrix] for matrix in found],
                "edits": [[e and flat(e[1]) for e in matrix] for matrix in found],
            },
            schema=target,
        )

    distinct = materialize(chunks.select("symbols").distinct(), "chunks")
    groups = group_count(distinct, F.length("symbols"), GROUP_SYMBOLS)
    dealt = distinct.withColumn("grp", F.pmod(F.xxhash64("symbols"), F.lit(groups)))
    return dealt.groupBy("grp").applyInArrow(run, MATRICES)


class Way(NamedTuple):
    """The cheapest edits up to a chunk's end in one state; ``edits`` are the last chunk's."""

    cost: int
    edits: object
    state: int
    before: Way | None


def _extend(ways: list, matrix: list) -> list:
    """The cheapest way to every state after one more chunk."""
    extended = [None] * 4
    for q in range(4):
        for p, way in enumerate(ways):
            entry = way and matrix[4 * p + q]
            if not entry:
                continue
            new, old = Way(way.cost + entry[0], entry[1], p, way), extended[q]
            if old is None or new.cost < old.cost or (new.cost == old.cost and _way_before(new, old)):
                extended[q] = new
    return extended


def _way_before(a: Way, b: Way) -> bool:
    x, y = [], []
    while a is not b:
        x.append(a.edits)
        y.append(b.edits)
        a, b = a.before, b.before
    return least(x[::-1], y[::-1])


def _cheapest(ways: list) -> Way:
    ends = [way for state, way in enumerate(_extend(ways, INSERTIONS)) if way and state in ACCEPTED]
    best = ends[0]
    for way in ends[1:]:
        if way.cost < best.cost or (way.cost == best.cost and _way_before(way, best)):
            best = way
    return best


LEGAL = {"su", "ua", "au"}


class _Fold:
    """Chunks of one conversation, multiplied as they come."""

    def __init__(self, conv):
        self.conv, self.chunks = conv, []
        self.ways, self.illegal, self.last = [Way(0, "", START, None), None, None, None], 0, ""

    def add(self, first: int, symbols: str, initials: str, costs: list, edits: list) -> None:
        self.chunks.append((first, symbols))
        self.ways = _extend(self.ways, [None if c is None else (c, e) for c, e in zip(costs, edits)])
        run = self.last + initials
        self.illegal += sum(run[i : i + 2] not in LEGAL for i in range(len(run) - 1))
        self.last = initials[-1]

    def rows(self) -> list[tuple]:
        """One per chunk; the last one has the conversation's cost, edits and illegal pairs."""
        way = _cheapest(self.ways)
        cost, tail, way = way.cost, flat(way.edits), way.before
        steps = []
        while way.before is not None:
            steps.append((way.state, flat(way.edits)))
            way = way.before
        steps.reverse()
        steps[-1] = (steps[-1][0], steps[-1][1] + tail)
        found = [
            (self.conv, first, symbols, state, piece, None, None, None)
            for (first, symbols), (state, piece) in zip(self.chunks, steps)
        ]
        found[-1] = (*found[-1][:5], cost, "".join(piece for _, piece in steps), self.illegal)
        return found


def _pieces(chunks: DataFrame) -> DataFrame:
    """The cheapest edits of every chunk, conversation by conversation, as a stream of sorted rows."""
    target = _arrow_schema(chunks.sparkSession, PIECES)

    def table(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) if found else [[]] * len(target)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    def run(batches):
        fold = None
        for batch in batches:
            found = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if fold is None or row[0] != fold.conv:
                    if fold is not None:
                        found += fold.rows()
                    fold = _Fold(row[0])
                fold.add(*row[1:])
            yield table(found)
        if fold is not None:
            yield table(fold.rows())

    columns = ["conv", "first", "symbols", "initials", "costs", "edits"]
    sorted_rows = chunks.repartition("conv").sortWithinPartitions("conv", "first")
    return sorted_rows.select(*columns).mapInArrow(run, PIECES)


EDITS = "place bigint, sub int, edit string, new_role string"


def _edits(pieces: DataFrame) -> DataFrame:
    """One row per turn that stands in the repaired conversation."""
    target = _arrow_schema(pieces.sparkSession, EDITS)

    def run(batches):
        for batch in batches:
            found = []
            for first, symbols, state, piece in zip(*(column.to_pylist() for column in batch.columns)):
                at = sub = 0
                for edit in piece:
                    if edit == "D":
                        at, sub = at + 1, 0
                        continue
                    role = None
                    if edit == "K":
                        state = STEP[state, symbols[at].lower()]
                    else:
                        state = filled(state)
                        role = ROLES[state]
                    if at < len(symbols):
                        found.append((first + at, sub, edit, role))
                    else:  # at the end: behind the last row, before which two turns at most are inserted
                        found.append((first + at - 1, 3 + sub, edit, role))
                    at, sub = (at, sub + 1) if edit == "I" else (at + 1, 0)
            columns = list(zip(*found)) if found else [[]] * len(target)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    return pieces.select("first", "symbols", "state", "piece").mapInArrow(run, EDITS)


class Repaired(NamedTuple):
    conversations: DataFrame
    turns: DataFrame


def repair_conversations(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> Repaired:
    """Faults of every conversation, and the cheapest edits that give its roles the form ``(s?(ua)+)?``.

    ``conversations`` has (conv, gaps, blank, duplicate, truncated, illegal, cost,
    audit), one row per conversation of the input; ``turns`` has (conv, place, sub,
    role, text, edit), the repaired turns, in the order of place, then sub.

    Rows are taken by turn, nulls first; rows of one turn by role, then by the
    SHA-256 of their text; rows equal in all of it are alike. A null text or role is
    empty. Rows with a null conversation are one conversation. Empty tables give
    empty results; other columns are ignored. Keeping a row costs 0, a new role 2,
    deleting 3, inserting an empty turn 2, keeping a row that is cut short 1 more;
    blank and repeated rows must go. Of equally cheap edits the ASCII-least stand.

    A conversation of any length is spread by range; no more than 256 of its rows
    meet in a group. Its chunks stream through one task, 1/256 of its rows, and its
    audit, a character a row, must fit one value.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    turns = rows.select(
        F.col(conv).cast("bigint").alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        content.alias("text"),
        F.sha2(content, 256).alias("digest"),
        F.rtrim(content, F.lit(SPACE)).alias("trimmed"),
    )
    end = F.right("trimmed", F.lit(1))
    turns = turns.withColumn(
        "fault", F.when(end == "", "blank").when(~end.isin(".", "!", "?"), "truncated").otherwise("")
    ).drop("trimmed")
    stored = placed(turns, "conv", ["turn", "role", "digest"])
    firsts = stored.where("fault <> 'blank'").groupBy("conv", "role", "digest").agg(F.min("place").alias("place"))
    light = stored.select("conv", "turn", "role", "fault", "place").join(
        firsts.select("place", F.lit(True).alias("is_first")), "place", "left"
    )
    fault = F.when((F.col("fault") != "blank") & F.col("is_first").isNull(), "duplicate").otherwise(F.col("fault"))
    initial = F.left("role", F.lit(1))
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    light = light.select(
        "conv", "turn", "place", fault.alias("fault"), initial.alias("initial"),
        F.when(fault.isin("blank", "duplicate"), "x").when(fault == "truncated", F.upper(initial))
        .otherwise(initial).alias("symbol"),
    )
    light = materialize(light, "symbols")

    chunk = F.shiftright("place", CHUNK_BITS).alias("chunk")
    listed = F.sort_array(F.collect_list(F.struct("place", "symbol", "initial")))
    chunks = light.groupBy("conv", chunk).agg(listed.alias("l")).select(
        "conv", F.col("l")[0]["place"].alias("first"),
        F.array_join("l.symbol", "").alias("symbols"), F.array_join("l.initial", "").alias("initials"),
    )
    chunks = materialize(chunks, "chunked")
    pieces = materialize(_pieces(chunks.join(_matrices(chunks), "symbols")), "pieces")

    count = lambda kind: F.count(F.when(F.col("fault") == kind, 1)).alias(kind)
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counted = light.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"), count("blank"), count("duplicate"), count("truncated")
    )
    ended = pieces.where("cost IS NOT NULL").select(F.col("conv").alias("ended"), "illegal", "cost", "audit")
    conversations = counted.join(ended, F.col("conv").eqNullSafe(F.col("ended"))).drop("ended")

    edits = _edits(pieces).join(stored.select("conv", "place", "role", "text"), "place")
    inserted = F.col("edit") == "I"
    repaired = edits.select(
        "conv", "place", "sub", F.coalesce("new_role", "role").alias("role"),
        F.when(inserted, "").otherwise(F.col("text")).alias("text"), "edit",
    )
    return Repaired(conversations, repaired)
