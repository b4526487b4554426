"""Language-model scores by a small causal self-attention model, trained and run in numpy.

Frequent words of the training texts are ids of their own, all others are spelled in
subword ids. Ids are ranked by their count in the training texts. The model embeds an id, attends to those before it in its window, and predicts the class of the next
one by the turns to take in a binary tree of classes; frequent ids are classes of
their own, the others share classes of about equal weight, within which an id has
its counted share. Windows overlap: the first part of each is context only, so
every token is scored once.

Counts come from every training text, and so do the blocks of words to train on, which
hold all words of these texts. Trainers take bounded groups of blocks,
start from the same weights, and their results are averaged after each round.
"""

from __future__ import annotations

import base64
import io
import math
import sys
import types
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import _arrow_schema, one_blas_thread


@dataclass(frozen=True)
class Settings:
    """Parameters of the model and its training; none depends on the size of the input."""

    width: int = 24
    hidden: int = 24
    context: int = 16  # ids a window sees before those it scores
    scored: int = 32
    embedded: int = 4_096  # most frequent ids with an embedding of their own
    shared: int = 64  # embeddings the other ids share
    own_classes: int = 96
    levels: int = 7  # of the tree; the other leaves of it are shared classes
    block: int = 128  # words of a training block; windows of 32 ids fill it to nine tenths
    lead: int = 17  # words before them, context only: enough ids where each word is one
    every: int = 1  # one block in so many is trained on; 1: all of them
    trainer_blocks: int = 2_048
    rounds: int = 2  # after the first trainer's
    batch: int = 16
    rate: float = 1.2e-2
    hot_words: int = 500_000  # at most so many words are broadcast with their counts
    hot_bytes: int = 64
    hot_least: int = 6  # times that such a word occurs, so that the others' spelling is learned too
    flush: int = 500_000  # words a task counts before it passes them on

    @property
    def classes(self) -> int:
        return 1 << self.levels

    @property
    def shared_classes(self) -> int:
        return self.classes - self.own_classes


LONGEST = 200  # characters of a word that are encoded together
KEPT_WORDS = 250_000  # beside the frequent ones, of which a worker keeps the ids


def split_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased; bytes know no other letters or spaces."""
    return (text or "").encode().lower().split()


def _in_parts(word: bytes) -> bytes:
    text = word.decode()
    return " ".join(text[i : i + LONGEST] for i in range(0, len(text), LONGEST)).encode()


class Subwords:
    """Ids of words by a byte-level vocabulary of ranks, and two ids beyond it for start and end.

    Words are joined by one space, which begins the word behind it, so a text's
    ids are those of its words in order, and only a word's first id begins with a
    space. New words are encoded together; past ``limit`` words the table starts
    anew. A longer word is read in parts of 200 characters, which bounds the work
    for text without spaces. The words of ``own`` have one id each, behind all others.
    """

    def __init__(self, path: str, pattern: str, limit: int = KEPT_WORDS, own: Sequence[bytes] = ()):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.start = max(ranks.values()) + 1
        self.end, self.size = self.start + 1, self.start + 2
        self.begins = np.zeros(self.size, bool)
        self.begins[[rank for piece, rank in ranks.items() if piece[:1] == b" "]] = True
        data = np.arange(self.size, self.size + len(own), dtype="<i4").tobytes()
        self.own = {word: data[4 * i : 4 * i + 4] for i, word in enumerate(own)}
        self.known: dict[bytes, bytes] = dict(self.own)
        self.limit = limit

    def _encode(self, words: list[bytes]) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary((b" " + b" ".join(words)).decode()), "<i4")

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The table, with the ids of these words as little-endian 32-bit bytes."""
        new = [w for w in words if w not in self.known]
        if len(self.known) - len(self.own) + len(new) > self.limit and len(self.known) > len(self.own):
            self.known, new = dict(self.own), [w for w in words if w not in self.own]
        long = [w for w in new if len(w) > LONGEST]
        short = [w for w in new if len(w) <= LONGEST]
        for at in range(0, len(short), 4_096):
            part = short[at : at + 4_096]
            ids = self._encode(part)
            cuts = np.flatnonzero(self.begins[ids])
            if len(cuts) == len(part):
                data, ends = ids.tobytes(), [*(4 * cuts[1:]).tolist(), 4 * len(ids)]
                for word, a, b in zip(part, (4 * cuts).tolist(), ends):
                    self.known[word] = data[a:b]
            else:
                long += part
        for word in long:
            self.known[word] = self._encode([_in_parts(word)] if len(word) > LONGEST else [word]).tobytes()
        return self.known

    def of(self, split: list[list[bytes]]) -> list[np.ndarray]:
        return [np.frombuffer(b"".join(self.pieces(words)), "<i4") for words in split]

    def pieces(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as bytes."""
        pieces = list(map(self.known.get, words))
        if None in pieces:
            self.learn({w for w, piece in zip(words, pieces) if piece is None})
            pieces = list(map(self.known.get, words))
            if None in pieces:  # the table started anew
                pieces = list(map(self.learn(set(words)).__getitem__, words))
        return pieces


def subwords(path: str, pattern: str, own: bytes = b"") -> Subwords:
    """This worker process's vocabulary, kept from task to task.

    ``own`` is a stream of the frequent words (``frequent_words``).
    """
    store = sys.modules.setdefault("attention_subwords", types.ModuleType("attention_subwords"))
    kept = store.__dict__.setdefault("kept", {})
    if (path, pattern, own) not in kept:
        words = pa.ipc.open_stream(own).read_all().column("word").to_pylist() if own else ()
        kept.clear()
        kept[path, pattern, own] = Subwords(path, pattern, own=words)
    return kept[path, pattern, own]


class Vocabulary(NamedTuple):
    """What counting ids yields: arrays by id."""

    row: np.ndarray  # of the embedding
    of_class: np.ndarray
    log_share: np.ndarray  # log10 of an id's share of its class
    odds: np.ndarray  # of each turn in the tree, as logits, by the shares of the classes below it
    start: int
    end: int


def vocabulary(counts: np.ndarray, start: int, end: int, s: Settings) -> Vocabulary:
    weight = counts + 0.1
    order = np.lexsort((np.arange(len(counts)), -counts))
    row = s.embedded + np.arange(len(counts)) % s.shared
    row[order[: s.embedded]] = np.arange(min(s.embedded, len(order)))
    of_class = np.zeros(len(counts), np.int64)
    own = min(s.own_classes, len(order))
    of_class[order[:own]] = np.arange(own)
    rest = order[own:]
    before = np.cumsum(weight[rest]) - weight[rest]
    of_class[rest] = own + np.minimum(before * s.shared_classes // max(weight[rest].sum(), 1e-9), s.shared_classes - 1)
    totals = np.bincount(of_class, weight, s.classes) + 1e-9
    below = np.concatenate([np.zeros(s.classes), totals])
    for node in range(s.classes - 1, 0, -1):
        below[node] = below[2 * node] + below[2 * node + 1]
    odds = np.log(below[3::2] / below[2::2])  # node k is entry k - 1
    return Vocabulary(
        row.astype(np.int32), of_class.astype(np.int32), np.log10(weight / totals[of_class]), odds.astype(np.float32), start, end
    )


def turns(classes: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of the nodes on the way to each class, and the turns there: 1 right, -1 left."""
    down = np.arange(levels - 1, -1, -1)
    leaf = classes[..., None] + (1 << levels)
    return (leaf >> (down + 1)) - 1, (2 * ((leaf >> down) & 1) - 1).astype(np.float32)


def log_sigmoid(x: np.ndarray) -> np.ndarray:
    return np.minimum(x, 0) - np.log1p(np.exp(-np.abs(x)))


def windows(ids: np.ndarray, s: Settings, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Input and target ids by window, -1 where there is none.

    ``ids`` begins with what is context only, ``skip`` + 1 ids. Row k scores targets
    ``scored`` * k onwards and sees ``context`` inputs more before them.
    """
    targets = ids[1 + skip :].astype(np.int64)
    n = -(-len(targets) // s.scored)
    size = s.context + n * s.scored
    inputs = np.full(size, -1, np.int64)
    known = ids[max(0, skip - s.context) : len(ids) - 1]
    from_ = s.context - min(skip, s.context)
    inputs[from_ : from_ + len(known)] = known
    padded = np.full(n * s.scored, -1, np.int64)
    padded[: len(targets)] = targets
    at = np.arange(s.context + s.scored) + s.scored * np.arange(n)[:, None]
    return inputs[at], padded.reshape(n, s.scored)


def sums(e: np.ndarray) -> np.ndarray:
    """Sums along the last axis, which is kept; a product is faster than adding along a short axis."""
    return (e @ np.ones(e.shape[-1], e.dtype))[..., None]


def exponentials(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(z - c) and its sums along the last axis; c is 0 but where that leaves the range of floats.

    Each row is decided on by itself, so it has the same result in any company.
    """
    top = float(z.max(initial=0))
    e = np.exp(z if top < 60 else np.minimum(z, np.float32(60)))
    total = sums(e)
    odd = total[..., 0] <= 1e-25
    if top >= 60:
        odd |= z.max(-1) >= 60
    if odd.any():
        e[odd] = np.exp(z[odd] - z[odd].max(-1, keepdims=True))
        total[odd] = e[odd].sum(-1, keepdims=True)
    return e, total


class Model:
    """One block of masked self-attention and a hidden layer, both added to their input."""

    def __init__(self, s: Settings, weights: dict[str, np.ndarray]):
        self.s, self.w = s, weights
        size = s.context + s.scored
        distance = np.arange(s.context, size)[:, None] - np.arange(size)
        self.causal = distance >= 0
        self.itself = distance == 0
        self.distance = np.maximum(distance, 0)
        self.scale = np.float32(1 / math.sqrt(s.width))
        self.nodes, self.sides = turns(np.arange(s.classes), s.levels)

    @staticmethod
    def initial(s: Settings, odds: np.ndarray, seed: int = 11) -> dict[str, np.ndarray]:
        draw = np.random.default_rng(seed)
        normal = lambda *shape: (draw.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)
        d = s.width
        return {
            "embedding": (draw.standard_normal((s.embedded + s.shared, d)) * 0.3).astype(np.float32),
            "query": normal(d, d), "key": normal(d, d), "value": normal(d, d), "mix": normal(d, d) * np.float32(0.5),
            "near": np.zeros(s.context + s.scored, np.float32),
            "up": normal(d, s.hidden), "up_bias": np.zeros(s.hidden, np.float32), "down": normal(s.hidden, d) * np.float32(0.5),
            "out": normal(d, s.classes - 1) * np.float32(0.1), "out_bias": odds.astype(np.float32),
        }

    def attention(self, q: np.ndarray, k: np.ndarray, present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of what each scored place sees, and their sums: itself and what stands before it."""
        z = q @ k.transpose(0, 2, 1)
        z += np.where(self.causal, self.w["near"][self.distance], np.float32(-1e9))
        lacking = np.flatnonzero(~present.all(1))
        if len(lacking):  # a place without an id sees itself, which is nothing
            seen = present[lacking][:, None, :] | self.itself
            z[lacking] += np.where(seen, np.float32(0), np.float32(-1e9))
        return exponentials(z)

    def layers(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hidden units, outputs and logits of the places' sums of input and attention."""
        u = np.maximum(h @ self.w["up"] + self.w["up_bias"], 0)
        o = h + u @ self.w["down"]
        return u, o, o @ self.w["out"] + self.w["out_bias"]

    def gradients(self, rows: np.ndarray, targets: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """Mean loss over the targets (classes, -1 where none), its gradient, and the embedding rows that it is of.

        ``rows`` are embedding rows by window, -1 where there is no id.
        """
        w, s, c = self.w, self.s, self.s.context
        flat = lambda a: a.reshape(-1, a.shape[-1])
        present = rows >= 0
        x = w["embedding"].take(np.maximum(rows, 0).ravel(), 0).reshape(*rows.shape, s.width)
        x *= present[..., None]
        q, v = (x[:, c:] @ w["query"]) * self.scale, x @ w["value"]
        k = x @ w["key"]
        a, total = self.attention(q, k, present)
        a /= total
        seen = a @ v
        h = flat(x[:, c:] + seen @ w["mix"])
        u, o, logits = self.layers(h)
        goal = targets.ravel()
        at = np.flatnonzero(goal >= 0)
        n = max(1, len(at))
        nodes, sides = self.nodes.take(goal[at], 0), self.sides.take(goal[at], 0)
        nodes += at[:, None] * logits.shape[1]
        taken = sides * logits.ravel().take(nodes)
        loss = -float(log_sigmoid(taken).sum()) / n
        p = np.zeros_like(logits)
        p.ravel()[nodes] = -sides / (1 + np.exp(np.minimum(taken, 60))) / n
        g = {"out": o.T @ p, "out_bias": p.sum(0)}
        d_o = p @ w["out"].T
        g["down"] = u.T @ d_o
        d_u = (d_o @ w["down"].T) * (u > 0)
        g["up"], g["up_bias"] = h.T @ d_u, d_u.sum(0)
        d_h = (d_o + d_u @ w["up"].T).reshape(seen.shape)
        g["mix"] = flat(seen).T @ flat(d_h)
        d_seen = d_h @ w["mix"].T
        d_v = a.transpose(0, 2, 1) @ d_seen
        d_z = d_seen @ v.transpose(0, 2, 1)
        # The weighted mean of what a place's weights gain is that of its output.
        d_z -= (d_seen * seen).sum(-1, keepdims=True)
        d_z *= a
        g["near"] = np.bincount(self.distance.ravel(), (d_z.sum(0) * self.causal).ravel(), len(w["near"])).astype(np.float32)
        d_q, d_k = (d_z @ k) * self.scale, d_z.transpose(0, 2, 1) @ q
        g["query"], g["key"], g["value"] = flat(x[:, c:]).T @ flat(d_q), flat(x).T @ flat(d_k), flat(x).T @ flat(d_v)
        d_x = d_k @ w["key"].T + d_v @ w["value"].T
        d_x[:, c:] += d_h + d_q @ w["query"].T
        place = np.flatnonzero(present)
        held = rows.ravel()[place]
        order = np.argsort(held, kind="stable")
        held = held[order]
        starts = np.flatnonzero(np.diff(held, prepend=-1))
        used = held[starts]
        d_x = flat(d_x).take(place[order], 0)
        g["embedding"] = np.add.reduceat(d_x, starts) if len(used) else np.zeros((0, s.width), np.float32)
        return loss, g, used

    def train(self, rows: np.ndarray, targets: np.ndarray, seed: int) -> None:
        """One pass in random order, by Adam with a rate that falls to a tenth."""
        s, draw = self.s, np.random.default_rng(seed)
        order = draw.permutation(len(rows))
        batches = [order[i : i + s.batch] for i in range(0, len(order), s.batch)]
        # All weights but the embedding lie in one array, so a step updates them together.
        dense = [name for name in self.w if name != "embedding"]
        flat = np.concatenate([self.w[name].ravel() for name in dense])
        ends = np.cumsum([self.w[name].size for name in dense])[:-1]
        self.w |= {name: part.reshape(self.w[name].shape) for name, part in zip(dense, np.split(flat, ends))}
        embedding = self.w["embedding"]
        first, second = np.zeros_like(flat), np.zeros_like(flat)
        moments = np.zeros((2, *embedding.shape), embedding.dtype)
        for step, batch in enumerate(batches, 1):
            _, g, used = self.gradients(rows[batch], targets[batch])
            x, y = np.concatenate([g[name].ravel() for name in dense]), g["embedding"]
            norm = math.sqrt(float(x @ x) + float(y.ravel() @ y.ravel()))
            clip = np.float32(min(1.0, 1.0 / (norm + 1e-9)))
            rate = s.rate * (1 - 0.9 * step / len(batches))
            rate = np.float32(rate * math.sqrt(1 - 0.99**step) / (1 - 0.9**step))
            x *= clip
            y *= clip
            first += np.float32(0.1) * (x - first)
            second += np.float32(0.01) * (x * x - second)
            flat -= rate * first / (np.sqrt(second) + np.float32(1e-6))
            a, b = moments[0].take(used, 0), moments[1].take(used, 0)  # rows that were not used stay
            a += np.float32(0.1) * (y - a)
            b += np.float32(0.01) * (y * y - b)
            moments[0][used], moments[1][used] = a, b
            embedding[used] -= rate * a / (np.sqrt(b) + np.float32(1e-6))


def packed(weights: dict[str, np.ndarray]) -> bytes:
    return b"".join(weights[name].tobytes() for name in sorted(weights))


def unpacked(data: bytes, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    result, at = {}, 0
    for name in sorted(like):
        size = like[name].nbytes
        result[name] = np.frombuffer(data[at : at + size], np.float32).reshape(like[name].shape).copy()
        at += size
    return result


COUNTED = "word binary, n bigint, block binary, lead int, part int, mixed bigint"


def _count_words(texts: DataFrame, s: Settings) -> DataFrame:
    """Words with their counts, task by task, and the blocks to train on.

    The end of a text is the null word. A block has the words before it (``lead`` of
    them) joined to its own by spaces; ``part`` is 1 at the start of a text, 2 at its
    end, 3 if both. ``mixed`` is a random number, by which blocks are dealt to trainers.
    """
    target = _arrow_schema(texts.sparkSession, COUNTED)

    def counted(counter: Counter) -> pa.RecordBatch:
        n, none = len(counter), [None] * len(counter)
        return pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip((list(counter), list(counter.values()), none, none, none, none), target)],
            schema=target,
        ) if n else pa.RecordBatch.from_pylist([], schema=target)

    def run(batches):
        counter: Counter = Counter()
        draw = np.random.default_rng((17, TaskContext.get().partitionId()))
        for batch in batches:
            blocks = []
            for text in batch.column(0).to_pylist():
                words = split_words(text)
                counter.update(words)
                counter[None] += 1
                chosen = zlib.crc32(b" ".join(words[: s.block])) % s.every
                n = max(1, -(-len(words) // s.block))
                for k in range(chosen, n, s.every):
                    a = max(0, k * s.block - s.lead)
                    own = words[a : (k + 1) * s.block]
                    blocks.append((None, None, b" ".join(own), k * s.block - a, (k == 0) + 2 * (k == n - 1)))
                if len(counter) > s.flush:
                    yield counted(counter)
                    counter = Counter()
            columns = [*zip(*blocks), draw.integers(0, 1 << 62, len(blocks))] if blocks else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)
        yield counted(counter)

    return materialize(texts.mapInArrow(run, COUNTED), "lm-counted")


def _id_counts(words: DataFrame, tokenizer: tuple[str, str], size: int) -> np.ndarray:
    """Counts of all ids over all training texts, from distinct words; one row per id reaches the driver."""
    target = _arrow_schema(words.sparkSession, "id int, n bigint")

    def run(batches):
        table = subwords(*tokenizer)
        total = np.zeros(size, np.int64)
        for batch in batches:
            words = batch.column(0).to_pylist()
            table.learn(set(words))
            found = table.of([[w] for w in words])
            times = np.repeat(batch.column(1).to_numpy(), list(map(len, found)))
            np.add.at(total, np.concatenate([np.zeros(0, np.int64), *found]), times)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(total[ids])], schema=target)

    rows = words.select("word", "n").mapInArrow(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size, np.int64)
    for row in rows:
        counts[row["id"]] = row["n"]
    return counts


def _examples(table: pa.Table, words_ids: Subwords, vocab: Vocabulary, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows and target classes of the windows of training blocks, as ``windows`` cuts them."""
    blocks = [b.split() for b in table.column("block").to_pylist()]
    leads, parts = table.column("lead").to_numpy(), table.column("part").to_numpy()
    pieces = words_ids.pieces([word for words in blocks for word in words])
    found = np.frombuffer(b"".join(pieces), "<i4")
    sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
    before = np.cumsum([0, *map(len, pieces)]) // 4  # ids before each word
    at = np.cumsum(sizes) - sizes
    n = before[at + sizes] - before[at]
    lead = before[at + leads] - before[at]
    starts, ends = parts & 1, parts >> 1
    size = n + starts + ends
    begin = np.cumsum(size) - size
    ids = np.empty(size.sum(), np.int64)
    ids[np.arange(len(found)) + np.repeat(begin + starts - before[at], n)] = found
    ids[begin[starts == 1]] = vocab.start
    ids[(begin + size - 1)[ends == 1]] = vocab.end
    skip = np.where(starts == 1, 0, np.maximum(0, lead - 1))
    cut = np.maximum(0, -(-(size - 1 - skip) // s.scored))
    owner = np.repeat(np.arange(len(blocks)), cut)
    first = (begin + skip)[owner] + s.scored * (np.arange(len(owner)) - np.repeat(np.cumsum(cut) - cut, cut))
    last = (begin + size - 1)[owner][:, None]
    x = first[:, None] + np.arange(-s.context, s.scored)
    y = first[:, None] + np.arange(1, s.scored + 1)
    seen = (x >= (begin + np.maximum(0, skip - s.context))[owner][:, None]) & (x < last)
    x, rows = np.where(seen, x, 0), vocab.row[ids]
    wanted, classes = y <= last, vocab.of_class[ids]
    y = np.where(wanted, y, 0)
    return np.where(seen, rows[x], -1).astype(np.int64), np.where(wanted, classes[y], -1).astype(np.int64)


TRAINED = "block int, trainer bigint, n bigint, weights binary"
BLOCK_BYTES = 1 << 18
AVERAGED = 64


def _train_round(
    blocks: DataFrame, weights: dict, vocab: Vocabulary, tokenizer: tuple[str, str], frequent: Broadcast, s: Settings, seed: int
) -> dict:
    """Weights after every trainer's pass, averaged by their numbers of windows."""
    spark = blocks.sparkSession
    # Plain values only: executors unpickle a broadcast without this package.
    shared = spark.sparkContext.broadcast((packed(weights), tuple(vocab)))
    like = {name: np.empty(v.shape, np.float32) for name, v in weights.items()}
    target = _arrow_schema(spark, TRAINED)

    def pieces(trainer: int, n: int, data: bytes) -> pa.Table:
        cut = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        columns = [range(len(cut)), [trainer] * len(cut), [n] * len(cut), cut]
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, target)], schema=target)

    def run(table: pa.Table) -> pa.Table:
        trainer = table.column("trainer")[0].as_py()
        table = table.sort_by([("block", "ascending"), ("lead", "ascending"), ("part", "ascending")])
        one_blas_thread()
        data, vocab = shared.value
        x, y = _examples(table, subwords(*tokenizer, frequent.value), Vocabulary(*vocab), s)
        model = Model(s, unpacked(data, like))
        if len(x):
            model.train(x, y, seed + trainer)
        return pieces(trainer, len(x), packed(model.w))

    def average(table: pa.Table) -> pa.Table:
        n = table.column("n").to_numpy().astype(np.float64)
        share = n / n.sum() if n.sum() else np.full(len(n), 1 / len(n))
        total = sum(k * np.frombuffer(w, np.float32) for k, w in zip(share, table.column("weights").to_pylist()))
        first = table.column("trainer")[0].as_py() // AVERAGED
        columns = [[table.column("block")[0].as_py()], [first], [int(n.sum())], [total.astype(np.float32).tobytes()]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    trained = materialize(blocks.groupBy("trainer").applyInArrow(run, TRAINED), "lm-trained")
    trainers = (trained.agg(F.max("trainer")).first()[0] or 0) + 1
    while True:  # 64 at a time, so no group grows with the number of trainers
        trained = trained.groupBy("block", F.expr(f"trainer div {AVERAGED}")).applyInArrow(average, TRAINED)
        trainers = -(-trainers // AVERAGED)
        if trainers == 1:
            break
        trained = materialize(trained, "lm-averaged")
    found = sorted(trained.select("block", "weights").collect())
    shared.unpersist()
    return unpacked(b"".join(row["weights"] for row in found), like) if found else weights


def _trained(
    blocks: DataFrame, vocab: Vocabulary, tokenizer: tuple[str, str], frequent: Broadcast, s: Settings
) -> dict:
    """First one trainer's pass, then rounds in which all trainers take a part of their blocks each."""
    total = blocks.count()
    trainers = max(1, -(-total // s.trainer_blocks))
    place = F.pmod("mixed", F.lit(trainers * s.rounds))
    trainer = F.floor(place / s.rounds).alias("trainer")
    dealt = blocks.select("block", "lead", "part", trainer, (place % s.rounds).alias("turn"))
    weights = Model.initial(s, vocab.odds)
    if total:
        weights = _train_round(dealt.where("trainer = 0"), weights, vocab, tokenizer, frequent, s, seed=0)
        for turn in range(s.rounds):
            weights = _train_round(dealt.where(F.col("turn") == turn), weights, vocab, tokenizer, frequent, s, seed=turn + 1)
    return weights


class Scorer:
    """Log10 probabilities of texts given as ids.

    Queries, keys and values follow from the id alone, so they are worked out once
    per embedding; the last row of each table is that of no id.
    """

    def __init__(self, model: Model, vocab: Vocabulary, batch: int = 128):
        self.model, self.vocab, self.batch = model, vocab, batch
        w = model.w
        x = np.vstack([w["embedding"], np.zeros((1, model.s.width), np.float32)])
        self.scored = np.hstack([x, x @ w["query"] * model.scale])
        self.seen = np.hstack([x @ w["key"], x @ w["value"] @ w["mix"]])
        self.row = np.append(vocab.row, len(x) - 1)  # of id -1 too
        self.log_share = np.append(vocab.log_share, 0).astype(np.float32)
        self.nodes, self.sides = turns(np.append(vocab.of_class, 0), model.s.levels)

    def scores(self, texts: list[np.ndarray]) -> list[float]:
        s, v = self.model.s, self.vocab
        totals, held, rows = np.zeros(len(texts)), [], 0
        for n, ids in enumerate(texts):
            x, y = windows(np.concatenate([[v.start], ids, [v.end]]), s)
            held.append((n, x, y))
            rows += len(x)
            if rows >= self.batch or n == len(texts) - 1:
                owner = np.repeat([h[0] for h in held], [len(h[1]) for h in held])
                inputs, targets = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
                for i in range(0, len(inputs), self.batch):
                    part = slice(i, i + self.batch)
                    np.add.at(totals, owner[part], self._window_scores(inputs[part], targets[part]))
                held, rows = [], 0
        return totals.tolist()

    def _window_scores(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        s, d = self.model.s, self.model.s.width
        rows = self.row[inputs]
        seen = self.seen.take(rows.ravel(), 0).reshape(*rows.shape, 2 * d)
        scored = self.scored.take(rows[:, s.context :].ravel(), 0).reshape(-1, s.scored, 2 * d)
        e, total = self.model.attention(scored[..., d:], seen[..., :d], inputs >= 0)
        h = scored[..., :d] + (e @ seen[..., d:]) / total
        logits = self.model.layers(h.reshape(-1, d))[2]
        wanted = targets.ravel()
        taken = np.take_along_axis(logits, self.nodes[wanted], 1) * self.sides[wanted]
        # A product of seven stays within 32-bit floats down to -12; each place is decided on by itself.
        log_p = self.log_share[wanted] - np.log10(np.prod(1 + np.exp(-np.maximum(taken, np.float32(-12))), axis=1))
        steep = np.flatnonzero(taken.min(axis=1) < -12)
        if len(steep):
            log_p[steep] = self.log_share[wanted[steep]] + log_sigmoid(taken[steep]).sum(1) / np.float32(math.log(10))
        return np.where(targets >= 0, log_p.reshape(targets.shape), 0).sum(1, dtype=np.float64)


class Reader:
    """Texts to ids and, by the counts of frequent words, base scores.

    Every word has a number, the frequent ones the first; others get theirs as they come.
    """

    def __init__(self, words: list[bytes], log_p: np.ndarray, encoder: Subwords, limit: int = KEPT_WORDS):
        self.words, self.encoder, self.limit = words, encoder, limit
        self.log_p = np.append(log_p, 0)  # 0 of words that are not frequent
        self._begin()

    def _begin(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids: list[bytes] = []
        self._learn(self.words)

    def _learn(self, words) -> None:
        known = self.encoder.learn(set(words))
        self.number.update(zip(words, range(len(self.ids), len(self.ids) + len(words))))
        self.ids += [known[w] for w in words]

    def _numbers(self, words: list[bytes]) -> list[int]:
        found = list(map(self.number.get, words))
        if None in found:
            new = list({w for w, n in zip(words, found) if n is None})
            if len(self.ids) + len(new) > len(self.words) + self.limit:
                self._begin()
                new = list(set(words).difference(self.number))
            self._learn(new)
            found = list(map(self.number.__getitem__, words))
        return found

    def read(self, split: list[list[bytes]]) -> tuple[list[np.ndarray], list[float], list[Counter]]:
        """Of each text its ids, the base score of its frequent words, and its other words with their numbers."""
        frequent, ids, base, rare = len(self.words), [], [], []
        for words in split:
            numbers = self._numbers(words)
            spots = np.array(numbers, np.int64)
            base.append(float(self.log_p[np.minimum(spots, frequent)].sum()))
            rare.append(Counter([words[i] for i in np.flatnonzero(spots >= frequent).tolist()]))
            kept = self.ids
            ids.append(np.frombuffer(b"".join([kept[n] for n in numbers]), "<i4"))
        return ids, base, rare


SCORED = "row bigint, id bigint, n_tokens bigint, n_known bigint, base double, score double, rare array<struct<word: binary, n: bigint>>"


def attention_scores(
    docs: DataFrame,
    doc_id: str,
    text: str,
    tokenizer_path: str,
    pattern: str,
    learn: Column,
    settings: Settings = Settings(),
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Tokens are words and one end. ``base_score`` is the add-0.1 unigram score by counts
    from the rows where ``learn`` is true, ``score`` the model's log10 probability of the
    text's subword ids and its end. A null or empty text is its end alone; with
    nothing to learn from, counts are zero and the model is the untrained one. Equal
    texts get equal scores, to the rounding of 32-bit floats; repeated rows and null ids stay, each with its own; other
    columns are ignored. A text of any length is scored whole, window by window.

    The driver gets the ids' counts, the weights and the counts of words with more
    than 1/500,000 of all tokens, of which there are fewer than 500,000 and which are
    ids of their own. Counts of all other words meet the texts in a shuffle, where no word has more than that share.
    ``tokenizer_path`` is a file of byte-level ranks, ``pattern`` how it cuts text.
    """
    s, spark = settings, docs.sparkSession
    content = F.col(text).cast("string")
    every = docs.select(F.col(doc_id).cast("bigint").alias("id"), content.alias("text"))
    counted = _count_words(docs.where(F.coalesce(learn, F.lit(False))).select(content.alias("text")), s)
    words = counted.where("n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    words = materialize(words, "lm-word-counts")
    total, distinct, texts = words.agg(F.sum("n"), F.count("*"), F.sum(F.when(F.col("word").isNull(), F.col("n")))).first()
    total, texts = total or 0, texts or 0
    own, tokenizer = words.where("word IS NOT NULL"), (tokenizer_path, pattern)
    start, end, size = (lambda t: (t.start, t.end, t.size))(subwords(*tokenizer))
    hot = (F.col("n") > total / s.hot_words) & (F.col("n") >= s.hot_least) & (F.octet_length("word") <= s.hot_bytes)
    hot_rows = own.where(hot).select("word", "n").toArrow()
    stream = io.BytesIO()
    with pa.ipc.new_stream(stream, hot_rows.schema) as writer:
        writer.write_table(hot_rows)
    frequent = spark.sparkContext.broadcast(stream.getvalue())
    counts = _id_counts(own.where(~hot), tokenizer, size)
    counts[end] += texts
    counts = np.concatenate([counts, hot_rows.column("n").to_numpy()])
    vocab = vocabulary(counts, start, end, s)
    blocks = counted.where("block IS NOT NULL").select("block", "lead", "part", "mixed")
    weights = _trained(blocks, vocab, tokenizer, frequent, s)

    floor = total + 0.1 * (distinct + 1)
    shared = spark.sparkContext.broadcast((packed(weights), tuple(vocab)))
    like = {name: np.empty(v.shape, np.float32) for name, v in weights.items()}
    end_score = math.log10((texts + 0.1) / floor)
    target = _arrow_schema(spark, SCORED)

    def run(batches):
        data, vocab = shared.value
        table = pa.ipc.open_stream(frequent.value).read_all()
        one_blas_thread()
        log_p = np.log10((table.column("n").to_numpy() + 0.1) / floor)
        reader = Reader(table.column("word").to_pylist(), log_p, subwords(*tokenizer, frequent.value))
        scorer = Scorer(Model(s, unpacked(data, like)), Vocabulary(*vocab))
        row = TaskContext.get().partitionId() << 33
        kind = target.field("rare").type
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                split = [split_words(t) for t in part.column(1).to_pylist()]
                ids, base, rare = reader.read(split)
                n_words = np.fromiter(map(len, split), np.int64, len(split))
                n_rare = np.array([sum(words.values()) for words in rare], np.int64)
                pairs = pa.StructArray.from_arrays(
                    [
                        pa.array([w for words in rare for w in words], pa.binary()),
                        pa.array([n for words in rare for n in words.values()], pa.int64()),
                    ],
                    fields=list(kind.value_type),
                )
                ends = np.cumsum([0, *map(len, rare)]).astype(np.int32)
                columns = [
                    pa.array(range(row, row + len(split)), pa.int64()), part.column(0), pa.array(n_words + 1),
                    pa.array(n_words - n_rare + (texts > 0)), pa.array(np.array(base) + end_score),
                    pa.array(scorer.scores(ids), pa.float64()), pa.ListArray.from_arrays(pa.array(ends), pairs).cast(kind),
                ]
                row += len(split)
                yield pa.RecordBatch.from_arrays(columns, schema=target)

    scored = materialize(every.mapInArrow(run, SCORED), "lm-scored")
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    rare = rare.join(own.where(~hot), "word", "left")
    seen = F.coalesce("n", F.lit(0))
    rare = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10((seen + 0.1) / F.lit(floor))).alias("rare_base"),
        F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    found = scored.drop("rare").join(rare, "row", "left")
    return found.select(
        F.col("id").alias("doc_id"), "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), "score",
    )
