"""Attention scores, prefix tries and structure repair against plain versions."""

import dataclasses
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import attention_scoring as lm
from tallyfold.llm import prefix_trie as trie
from tallyfold.llm import structure_repair as repair
from tallyfold.llm.oracle import ORACLE
from tallyfold.llm.ordered import joined_sha256, placed, positions
from tallyfold.llm.queries import QUERIES, damaged, rebuilt, tokenizer_path, tokenizer_pattern

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- ordered rows ---------------------------------------------------------


def test_places_and_positions(spark):
    draw = random.Random(2)
    rows = [(draw.choice([1, 1, 1, 2, 3, None]), draw.randrange(50), i) for i in range(3000)]
    frame = spark.createDataFrame(rows, "g bigint, o bigint, i bigint")
    stored = placed(frame, "g", ["o", "i"])
    got = [(r.g, r.o, r.i) for r in stored.orderBy("place").collect()]
    assert got == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    numbered = positions(stored, "g").collect()
    for g in (1, 2, 3):
        own = sorted((r.pos, r.o, r.i) for r in numbered if r.g == g)
        assert own == [(n, o, i) for n, (_, o, i) in enumerate(sorted(r for r in rows if r[0] == g))]
    hashed = {r.g: r.sha256 for r in joined_sha256(stored.withColumn("line", F.col("i").cast("string")), "g", ["place"], "line", ",").collect()}
    for g in (1, 2, 3, None):
        assert hashed[g] == sha(",".join(str(r[2]) for r in sorted((r for r in rows if r[0] == g), key=lambda r: r[1:])))


# --- structure repair -----------------------------------------------------


def after(state, initial):
    return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, initial))


def all_audits(symbols):
    """(cost, audit) of every way that inserts no more than two turns in a place."""
    found = []

    def go(i, state, cost, audit, inserted):
        if i == len(symbols) and state in (0, 3):
            found.append((cost, audit))
        if inserted < 2:
            go(i, after(state, "a" if state == 2 else "u"), cost + 2, audit + "I", inserted + 1)
        if i < len(symbols):
            symbol, cut = symbols[i].lower(), symbols[i].isupper()
            go(i + 1, state, cost + 3, audit + "D", 0)
            if symbol != "x":
                go(i + 1, after(state, "a" if state == 2 else "u"), cost + 2 + cut, audit + "R", 0)
                if after(state, symbol) is not None:
                    go(i + 1, after(state, symbol), cost + cut, audit + "K", 0)

    go(0, 0, 0, "", 0)
    return min(found)


def cheapest(matrix):
    ways = repair._extend([repair.Way(0, "", 0, None), None, None, None], matrix)
    best = repair._cheapest(ways)
    return best.cost, repair.flat(best.before.edits) + repair.flat(best.edits)


def test_matrices_equal_exhaustive_search():
    words = ["".join(w) for n in (1, 2) for w in itertools.product(repair.ALPHABET, repeat=n)]
    draw = random.Random(3)
    words += ["".join(draw.choices(repair.ALPHABET, k=n)) for n in (3, 4, 5) for _ in range(40)]
    words += ["suaua", "sssss", "aaaaa", "uuuuu", "ouaou", "xxxxx", "UAUA"]
    for word, matrix in zip(words, repair.chunk_matrices(words)):
        assert cheapest(matrix) == all_audits(word), word


def test_grammar_gives_the_words_back():
    draw = random.Random(4)
    words = ["".join(draw.choices("suaUAx", k=draw.randrange(1, 60))) for _ in range(200)] + ["u" * 37, "ua" * 40, "aaa"]
    rules, packed = repair.re_pair(words)

    def spell(symbol):
        if symbol < len(repair.ALPHABET):
            return repair.ALPHABET[symbol]
        left, right = rules[symbol - len(repair.ALPHABET)]
        return spell(left) + spell(right)

    assert ["".join(map(spell, word)) for word in packed] == words
    assert sum(map(len, packed)) + 2 * len(rules) < sum(map(len, words)) / 2
    # No pair of symbols is left that occurs twice without overlap.
    pairs = Counter()
    for word in packed:
        last = None
        for pair in zip(word, word[1:]):
            pairs[pair] += pair != last
            last = pair if pair != last else None
    assert max(pairs.values()) < 2


def test_ropes_compare_as_their_texts():
    draw = random.Random(5)

    def rope(depth):
        return repair.Rope(rope(depth - 1), rope(depth - 1)) if depth and draw.random() < 0.8 else draw.choice(["", "D", "DI", "K", "R"])

    for _ in range(2000):
        a, b = [rope(3) for _ in range(2)], [rope(3) for _ in range(2)]
        if draw.random() < 0.5:
            b[0] = a[0]
        x, y = "".join(map(repair.flat, a)), "".join(map(repair.flat, b))
        assert repair.least(a, b) == (x < y)


def plain_repair(rows):
    """One conversation's rows, damaged and in order: all that op13 returns but the id."""
    seen, faults = set(), []
    for turn, role, text in rows:
        body = text.strip(SPACE)
        if not body:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    ways = {0: (0, "", [])}
    insert = lambda s: (3, "assistant:") if s == 2 else (2, "user:")

    def filled(ways):
        best = dict(ways)
        for _ in range(2):
            for s, (cost, audit, lines) in list(best.items()):
                q, line = insert(s)
                new = (cost + 2, audit + "I", [*lines, line])
                if q not in best or new[:2] < best[q][:2]:
                    best[q] = new
        return best

    for (_, role, text), fault, initial in zip(rows, faults, initials):
        nxt = {}

        def offer(q, way):
            if q not in nxt or way[:2] < nxt[q][:2]:
                nxt[q] = way

        for s, (cost, audit, lines) in filled(ways).items():
            offer(s, (cost + 3, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                q, line = insert(s)
                offer(q, (cost + 2 + extra, audit + "R", [*lines, line + text]))
                if after(s, initial) is not None:
                    offer(after(s, initial), (cost + extra, audit + "K", [*lines, f"{role}:{text}"]))
        ways = nxt
    cost, audit, lines = min((w for s, w in filled(ways).items() if s in (0, 3)), key=lambda w: w[:2])
    count = Counter(faults)
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha("\n".join(lines))


def plain_damage(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        space = lambda v: " " if v is None else v
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind == 0:
            found[conv] += []
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        found[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha(r[2]))
    return {conv: sorted(own, key=order) for conv, own in found.items()}


def odd_conversations(draw):
    texts = ["Yes.", "No", "", None, " \t\n", "Why?", "x" * 3000 + ".", "Fine!", " ", "é𝒳."]
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool", "User"]
    rows = []
    for conv in [None, *range(-7, 60)]:
        for turn in range(draw.randrange(9)):
            at = draw.choice([turn, turn, turn, None, turn + 3, 0])
            rows.append((conv, at, draw.choice(roles), draw.choice(texts)))
    rows += rows[5:25]  # repeated whole
    # One conversation longer than a chunk, with alternating, then random roles.
    rows += [(1000, i, draw.choice(roles) if i > 400 else ("user", "assistant")[i % 2], f"Turn {i} of it.") for i in range(900)]
    return rows


def test_repair_equals_a_plain_version(spark, tmp_path):
    rows = odd_conversations(random.Random(6))
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("place", "first", "conv", "digest", "fault", "copy", "chunk"):
        frame = frame.withColumn(name, F.lit("extra"))
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op13_structure_repair"](spark, str(tmp_path)).collect()}
    want = {conv: plain_repair(own) if own else (0,) * 6 + ("", sha("")) for conv, own in plain_damage(rows).items()}
    assert got.keys() == want.keys()
    assert [c for c in want if got[c] != want[c]] == []
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet' WHERE conv_id IS DISTINCT FROM 1000")
    found = {r[0]: r[1:] for r in connection.execute(ORACLE["op13_structure_repair"]).fetchall()}
    assert found == {c: w for c, w in want.items() if c != 1000}


def test_repaired_turns_are_legal(spark):
    rows = odd_conversations(random.Random(7))
    turns = repair.repair_conversations(damaged(spark.createDataFrame(rows, SCHEMA)), "conv_id", "turn", "role", "text").turns
    by_conv = defaultdict(list)
    for r in sorted(turns.collect(), key=lambda r: (r.place, r["sub"])):
        by_conv[r.conv].append(r)
    for own in by_conv.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in own))
        assert all(r.text == "" for r in own if r.edit == "I")


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found = repair.repair_conversations(empty, "conv_id", "turn", "role", "text")
    assert found.conversations.count() == found.turns.count() == 0


# --- prefix trie ----------------------------------------------------------


def test_slots_are_minimal_and_perfect():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 5000):
        a = draw.integers(0, 2**63, n, dtype=np.uint64)
        b = draw.integers(0, 2**63, n, dtype=np.uint64)
        if n > 100:
            a[:50], b[50:100] = a[0], b[50]  # halves alone repeat
        slots = trie.MinimalPerfectHash(a, b).slots(a, b)
        assert sorted(slots.tolist()) == list(range(n))


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, (role or "").encode(), sha(text or ""), role or "", text or ""))
    own = {c: [(r[4], r[5]) for r in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    found = []
    totals = {}
    for p in sorted(members, key=len, reverse=True):
        below = [totals[c] for c in children[p]]
        leaves = sum(b[0] for b in below) or 1
        saved = sum(b[1] for b in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        totals[p] = (leaves, saved)
        ends = sorted(c for c in members[p] if len(built[c]) == len(p))
        found.append((
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves, saved,
            sha(",".join(map(str, ends))),
        ))
    return sorted(found, key=repr)


def trie_rows(draw):
    texts = ["Hello", "Bye", "", None, "é𝒳", "a:b", "longer text of a turn"]
    rows = []
    for conv in [None, *range(-12, 45), 2**40, 2**40 + 1]:
        if conv in (20, 21):
            continue  # a base that is absent
        for turn in range(draw.choice([0, 1, 2, 4, 6, 12])):
            rows.append((conv, draw.choice([turn, turn, turn, None]), draw.choice(["user", "assistant", None]), draw.choice(texts)))
    same = [("user", "Hello"), ("assistant", "Bye"), ("user", "Hello")] * 4
    rows += [(conv, i, *turn) for conv in range(100, 220) for i, turn in enumerate(same)]  # copies
    rows += [(conv, i, "user", f"turn {i % 7}") for conv in (500, 501) for i in range(2600)]  # several chunks
    rows.append((503, 2600, "user", "its end"))
    return rows + rows[:30]


def test_trie_equals_a_plain_version(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_TURNS", 500)
    rows = trie_rows(random.Random(8))
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("a", "b", "pos", "conv", "chunk", "depth", "grp", "t", "s"):
        frame = frame.withColumn(name, F.lit("extra"))
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted((tuple(r) for r in QUERIES["op12_prefix_trie"](spark, str(tmp_path)).collect()), key=repr)
    assert got == plain_trie(rows)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet' WHERE conv_id < 300 OR conv_id IS NULL")
    few = [r for r in rows if r[0] is None or r[0] < 300]
    assert sorted(connection.execute(ORACLE["op12_prefix_trie"]).fetchall(), key=repr) == plain_trie(few)


def test_hubs_are_broadcast_and_others_joined(spark, monkeypatch):
    monkeypatch.setattr(trie, "HUBS", 3)
    rows = trie_rows(random.Random(9))[:400]
    turns = trie.numbered_turns(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text")
    found = trie.prefix_trie(*rebuilt(turns)).drop("n_ends", "turn").collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    none = spark.createDataFrame([], "conv bigint, pos bigint, turn binary, bytes bigint")
    nobody = spark.createDataFrame([], "conv bigint")
    assert trie.prefix_trie(none, nobody).count() == 0
    some = spark.createDataFrame([(5,), (3,), (3,), (None,)], "conv bigint")
    (root,) = trie.prefix_trie(none, some).collect()
    assert (root.conv_id, root.depth, root.n_convs, root.n_ends, root.n_leaves, root.saved_tokens) == (3, 0, 2, 2, 1, 0)
    assert root.ends_sha256 == sha("3,5") and root.parent_conv_id is None


# --- language model -------------------------------------------------------

TOKENIZER = (tokenizer_path("byte_bpe_multi_50k.tiktoken"), tokenizer_pattern())
SMALL = lm.Settings(width=8, hidden=6, context=3, scored=5, embedded=20, shared=4, own_classes=10, levels=4)


def test_ids_of_a_text_are_those_of_its_words():
    table = lm.subwords(*TOKENIZER)
    texts = ["one two  three", "a,b c! d's 1234567 x_y", "é𝒳 中文 \U0001f600 tab\tnew\nline", "x" * 1000 + " y", "", "<|endoftext|> it's I'LL"]
    split = [lm.split_words(t) for t in texts]
    for words, ids in zip(split, table.of(split)):
        assert ids.tolist() == [i for w in words for i in table.of([[w]])[0].tolist()]
        if words and max(map(len, words)) <= lm.LONGEST:
            assert table.encoding.decode(ids.tolist()).split() == b" ".join(words).decode().split()


def test_a_small_table_of_words_starts_anew():
    table = lm.Subwords(*TOKENIZER, limit=5)
    split = [[b"a%d" % i for i in range(n, n + 4)] for n in range(0, 40, 3)] + [[b"w%d" % i for i in range(30)], []]
    assert [ids.tolist() for ids in table.of(split)] == [ids.tolist() for ids in lm.subwords(*TOKENIZER).of(split)]


def test_reading_words_by_number():
    table = lm.Subwords(*TOKENIZER, limit=50)
    hot = [b"the", b"of", b"and"]
    split = [lm.split_words(t) for t in ["the cat and the dog", "", "of w1 w2 w3 w4 w5 w6 the w1", "cat " * 5 + " ".join(f"x{i}" for i in range(20))]]
    reader = lm.Reader(hot, np.array([-1.0, -2.0, -4.0]), table, limit=6)
    for _ in range(2):
        ids, base, rare = reader.read(split)
        assert [i.tolist() for i in ids] == [i.tolist() for i in lm.subwords(*TOKENIZER).of(split)]
        assert base == [-6.0, 0.0, -3.0, 0.0]
        assert rare[0] == {b"cat": 1, b"dog": 1} and rare[2][b"w1"] == 2 and rare[3][b"cat"] == 5


def test_products_use_one_thread():
    from tallyfold.llm.common import one_blas_thread

    one_blas_thread()
    assert (np.ones((300, 300)) @ np.ones((300, 300)) == 300).all()


def small_vocabulary(n=40):
    return lm.vocabulary(np.arange(n)[::-1].astype(np.int64) ** 2, n - 2, n - 1, SMALL)


def class_shares(logits):
    """Probability of every class, leaf by leaf."""
    shares = []
    for c in range(SMALL.classes):
        nodes, sides = lm.turns(np.array([c]), SMALL.levels)
        shares.append(np.exp(lm.log_sigmoid(sides[0] * logits[nodes[0]]).sum()))
    return np.array(shares)


def test_vocabulary_shares_add_up():
    vocab = small_vocabulary()
    shares = class_shares(vocab.odds.astype(np.float64))
    assert abs(shares.sum() - 1) < 1e-9
    # Untrained, an id has its counted share.
    counts = np.arange(40)[::-1] ** 2 + 0.1
    found = 10**vocab.log_share * shares[vocab.of_class]
    assert np.allclose(found, counts / counts.sum(), rtol=1e-5)
    for c in range(SMALL.classes):
        members = vocab.of_class == c
        assert not members.any() or abs((10 ** vocab.log_share[members]).sum() - 1) < 1e-6


@pytest.mark.parametrize("skip", [0, 1, 2, 3, 7])
@pytest.mark.parametrize("n", [1, 4, 5, 6, 17])
def test_windows_score_each_token_once(n, skip):
    ids = np.arange(100, 101 + skip + n)
    x, y = lm.windows(ids, SMALL, skip)
    assert y[y >= 0].tolist() == ids[1 + skip :].tolist()
    for inputs, targets in zip(x, y):
        for place, target in enumerate(targets):
            if target >= 0:
                seen = inputs[: SMALL.context + place + 1]
                seen = seen[seen >= 0]
                assert seen[-1] == target - 1 and (np.diff(seen) == 1).all()
                assert len(seen) >= min(SMALL.context + 1, target - ids[0])


def test_gradient_equals_differences():
    draw = np.random.default_rng(2)
    weights = {k: v.astype(np.float64) for k, v in lm.Model.initial(SMALL, small_vocabulary().odds).items()}
    weights["near"] += draw.standard_normal(weights["near"].shape) * 0.3
    model = lm.Model(SMALL, weights)
    rows = draw.integers(0, 24, (3, SMALL.context + SMALL.scored))
    rows[0, :3], rows[1, 6:] = -1, -1
    targets = draw.integers(0, SMALL.classes, (3, SMALL.scored))
    targets[1, 3:] = -1
    _, gradient, used = model.gradients(rows, targets)
    for name, value in weights.items():
        flat = value.reshape(-1)
        for at in draw.choice(len(flat), min(12, len(flat)), replace=False):
            old, step = flat[at], 1e-5
            flat[at] = old + step
            up = model.gradients(rows, targets)[0]
            flat[at] = old - step
            down = model.gradients(rows, targets)[0]
            flat[at] = old
            if name == "embedding":
                row, column = divmod(at, SMALL.width)
                found = gradient[name][np.searchsorted(used, row), column] if row in used else 0.0
            else:
                found = gradient[name].reshape(-1)[at]
            assert abs(found - (up - down) / (2 * step)) < 2e-4, (name, at)


def plain_scores(model, vocab, ids):
    """Token by token, with one full softmax over the ids."""
    s, w = model.s, {k: v.astype(np.float64) for k, v in model.w.items()}
    framed = [vocab.start, *ids, vocab.end]
    total = 0.0
    for t in range(1, len(framed)):
        first = (t - 1) // s.scored * s.scored - s.context
        seen = framed[max(0, first) : t]
        x = w["embedding"][vocab.row[seen]]
        q, k, v = x[-1] @ w["query"] / math.sqrt(s.width), x @ w["key"], x @ w["value"]
        z = k @ q + w["near"][np.arange(len(seen))[::-1]]
        a = np.exp(z - z.max())
        h = x[-1] + (a / a.sum()) @ v @ w["mix"]
        o = h + np.maximum(h @ w["up"] + w["up_bias"], 0) @ w["down"]
        logits = o @ w["out"] + w["out_bias"]
        every = class_shares(logits)[vocab.of_class] * 10**vocab.log_share
        assert abs(every.sum() - 1) < 1e-6
        total += math.log10(every[framed[t]])
    return total


def test_scores_equal_token_by_token():
    vocab, draw = small_vocabulary(), np.random.default_rng(3)
    model = lm.Model(SMALL, lm.Model.initial(SMALL, vocab.odds))
    for name in ("near", "out", "up_bias"):
        model.w[name] += draw.standard_normal(model.w[name].shape).astype(np.float32)
    texts = [draw.integers(0, 40, n) for n in (0, 1, 4, 5, 6, 33, 200)]
    for batch in (1, 4, 64):
        got = lm.Scorer(model, vocab, batch=batch).scores(texts)
        assert np.allclose(got, [plain_scores(model, vocab, t) for t in texts], rtol=1e-4, atol=1e-3)


def test_a_text_scores_the_same_in_any_company():
    s, draw = lm.Settings(), np.random.default_rng(1)
    lm.one_blas_thread()  # as in workers
    for seed in range(8):
        vocab = lm.vocabulary(draw.zipf(1.3, 3000) % 100_000, 2998, 2999, s)
        model = lm.Model(s, lm.Model.initial(s, vocab.odds, seed))
        model.w["out"] += draw.standard_normal(model.w["out"].shape).astype(np.float32) * 2
        scorer, empty = lm.Scorer(model, vocab), np.zeros(0, np.int64)
        alone = scorer.scores([empty])[0]
        for n in (5, 900, 3_000):
            found = scorer.scores([empty, draw.integers(0, 2990, n), empty])
            assert found[0] == found[2] == alone


def test_large_logits_do_not_overflow():
    assert np.allclose(lm.log_sigmoid(np.array([1000.0, -1000.0, 0.0])), [0, -1000, -math.log(2)])
    z = np.array([[1000.0, 999.0], [-1000.0, -1001.0], [0.0, -1.0]], np.float32)
    e, total = lm.exponentials(z)
    assert np.allclose(e / total, [[0.731059, 0.268941]] * 3, atol=1e-5)


def test_training_learns_an_order():
    vocab, draw = small_vocabulary(), np.random.default_rng(4)
    after_id = draw.permutation(30)
    ids = [0]
    for _ in range(6000):
        ids.append(int(after_id[ids[-1]]) if draw.random() < 0.9 else int(draw.integers(0, 30)))
    x, y = lm.windows(np.array(ids), SMALL)
    model = lm.Model(SMALL, lm.Model.initial(SMALL, vocab.odds))
    held = [np.array(ids[5000:])]
    untrained = lm.Scorer(model, vocab).scores(held)[0]
    cut = len(x) * 5 // 6
    rows, classes = np.where(x >= 0, vocab.row[x], -1), np.where(y >= 0, vocab.of_class[y], -1)
    for seed in range(6):
        model.train(rows[:cut], classes[:cut], seed)
    assert lm.Scorer(model, vocab).scores(held)[0] > 0.8 * untrained


def plain_base(rows, learned):
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for i, t in rows}
    counts, ends = Counter(), 0
    for i in learned:
        counts.update(tokens[i])
        ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    floor = n + 0.1 * (v + 1)
    found = {}
    for i, words in tokens.items():
        score = sum(math.log10((counts[w] + 0.1) / floor) for w in words) + math.log10((ends + 0.1) / floor)
        found[i] = (len(words) + 1, sum(counts[w] > 0 for w in words) + (ends > 0), n, score)
    return found


def test_scores_of_documents(spark, sf):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    learned = [i for i in rows if zlib.crc32(str(i).encode()) % 10]
    want = plain_base(rows.items(), learned)
    found = QUERIES["op11_attention_scores"](spark, sf).collect()
    assert len(found) == len(rows)
    for r in found:
        n_tokens, n_known, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.held_out == (r.doc_id not in set(learned))
        assert r.score < 0


def test_rare_words_meet_their_counts_in_a_shuffle(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    learn = F.col("doc_id") % 3 > 0
    score = lambda **s: {
        r.doc_id: r for r in lm.attention_scores(documents, "doc_id", "text", *TOKENIZER, learn, dataclasses.replace(lm.Settings(), every=50, **s)).collect()
    }
    few, none = score(hot_words=20), score(hot_words=10**9, hot_bytes=0, flush=50)
    for i, r in few.items():
        assert (r.n_known, r.n_tokens) == (none[i].n_known, none[i].n_tokens)
        assert math.isclose(r.base_score, none[i].base_score, rel_tol=1e-9)


def test_held_out_text_scores_above_the_untrained_model(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'")
    learn = F.col("doc_id") % 10 > 0
    totals = []
    for settings in (lm.Settings(rate=0.0), lm.Settings()):
        found = lm.attention_scores(documents, "doc_id", "text", *TOKENIZER, learn, settings)
        totals.append(found.where("doc_id % 10 = 0").agg(F.sum("score")).first()[0])
    assert totals[1] > 0.95 * totals[0]


def test_every_word_of_a_training_text_is_trained_on(spark):
    texts = [" ".join(f"w{t}-{i}" for i in range(n)) for t, n in enumerate((0, 1, 31, 32, 33, 2_000))]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = lm._count_words(frame, lm.Settings()).where("block IS NOT NULL").collect()
    own = Counter(w.decode() for r in found for w in r["block"].split()[r["lead"] :])
    assert own == Counter(w for t in texts for w in t.split())


def test_averaging_of_many_trainers(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    settings = dataclasses.replace(lm.Settings(), trainer_blocks=3, every=4, rounds=1)
    found = lm.attention_scores(documents, "doc_id", "text", *TOKENIZER, F.lit(True), settings)
    assert found.where("score < 0 AND NOT isnan(score)").count() == documents.count()


def test_scores_of_odd_rows(spark, odd_documents, no_documents):
    extra = odd_documents.select("*", *[F.lit("extra").alias(c) for c in ("row", "word", "n", "ids", "trainer", "rare", "score")])
    found = lm.attention_scores(extra, "doc_id", "text", *TOKENIZER, F.col("doc_id") != 4).collect()
    assert len(found) == odd_documents.count()
    empty = {(r.n_tokens, r.base_score, r.score) for r in found if r.n_tokens == 1}
    assert len(empty) == 1 and len([r for r in found if r.doc_id == 7]) == 2
    twins = [r for r in found if r.doc_id in (6, 7)]
    assert len({r.base_score for r in twins}) == 1 and all(math.isclose(r.score, twins[0].score, rel_tol=1e-6) for r in twins)
    untaught = lm.attention_scores(odd_documents, "doc_id", "text", *TOKENIZER, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens) for r in untaught} == {(0, 0)} and all(r.score < 0 for r in untaught)
    assert lm.attention_scores(no_documents, "doc_id", "text", *TOKENIZER, F.lit(True)).count() == 0


def test_frequent_words_are_ids_of_their_own():
    plain, own = lm.Subwords(*TOKENIZER), [b"the", b"uncharacteristically", b"d\xc3\xa9j\xc3\xa0"]
    table = lm.Subwords(*TOKENIZER, limit=6, own=own)
    words = lm.split_words("the uncharacteristically long DÉJÀ déjà vu, the end " + " ".join(f"z{i}" for i in range(9)))
    for _ in range(2):
        for word, piece in zip(words, table.pieces(words)):
            ids = np.frombuffer(piece, "<i4").tolist()
            assert ids == ([plain.size + own.index(word)] if word in own else plain.of([[word]])[0].tolist())


def test_examples_are_the_windows_of_blocks():
    table, draw = lm.Subwords(*TOKENIZER, own=[b"w1", b"w2"]), random.Random(6)
    vocab = small_vocabulary(table.size + 2)._replace(start=table.start, end=table.end)
    rows = [("", 0, 3), ("", 0, 1)]
    for part in (0, 1, 2, 3) * 12:
        words = [draw.choice(["w1", "w2", "w33", "uncharacteristically"]) for _ in range(draw.randrange(1, 30))]
        rows.append((" ".join(words), 0 if part & 1 else min(draw.randrange(9), len(words)), part))
    columns = [pa.array([r[0].encode() for r in rows]), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32())]
    x, y = lm._examples(pa.table(columns, ["block", "lead", "part"]), table, vocab, SMALL)
    want = []
    for text, lead, part in rows:
        words = text.encode().split()
        before, ids = (table.of([w])[0].tolist() for w in (words[:lead], words[lead:]))
        ids = [table.start] * (part & 1) + before + ids + [table.end] * (part >> 1)
        skip = 0 if part & 1 else max(0, len(before) - 1)
        if len(ids) > skip + 1:
            want += list(zip(*lm.windows(np.array(ids), SMALL, skip)))
    assert len(want) == len(x) == len(y)
    for found, classes, (inputs, targets) in zip(x, y, want):
        assert found.tolist() == np.where(inputs >= 0, vocab.row[inputs], -1).tolist()
        assert classes.tolist() == np.where(targets >= 0, vocab.of_class[targets], -1).tolist()


def test_each_id_of_a_training_block_sees_its_whole_context(spark):
    s = lm.Settings()
    assert s.context >= 16 and s.classes >= 128 and s.own_classes >= 96 and min(s.width, s.hidden) >= 24
    words = [f"w{i}" for i in range(700)]
    frame = spark.createDataFrame([(" ".join(words),)], "text string")
    blocks = lm._count_words(frame, s).where("block IS NOT NULL").select("block", "lead", "part").toArrow()
    table = lm.Subwords(*TOKENIZER, own=[w.encode() for w in words])
    vocab = lm.vocabulary(np.ones(table.size + len(words)), table.start, table.end, s)
    x, y = lm._examples(blocks, table, vocab, s)
    assert (y >= 0).sum() == len(words) + 1
    assert ((x[:, : s.context + 1] >= 0).sum(axis=1) < s.context + 1).sum() == 1  # at the text's start


def test_blocks_are_dealt_once_and_evenly(spark):
    frame = spark.createDataFrame([("same words in every text",)] * 3_000, "text string")
    found = lm._count_words(frame, lm.Settings()).where("block IS NOT NULL")
    dealt = [r["count"] for r in found.groupBy(F.pmod("mixed", F.lit(6)).alias("place")).count().collect()]
    assert sum(dealt) == 3_000 and len(dealt) == 6 and max(dealt) < 700
