"""Repeats, near copies, vectors, mixing, packing and the pipeline against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyfold.llm import spherical_cells
from tallyfold.llm.anchor_dedup import repeated_passages
from tallyfold.llm.components import connected_components
from tallyfold.llm.near_copies import similar_groups
from tallyfold.llm.packing import TournamentTree, pack_documents, pack_lengths
from tallyfold.llm.pfair_mixing import mix_sources
from tallyfold.llm.queries import QUERIES, tokenizer_path
from tallyfold.llm.simhash_trees import near_links, simhash_groups, spanning_links
from tallyfold.llm.spherical_cells import near_vectors


class Union:
    def __init__(self, n):
        self.p = list(range(n))

    def root(self, x):
        while self.p[x] != x:
            x = self.p[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.p[max(a, b)] = min(a, b)


def plain_repeats(rows, width):
    seen, out = set(), []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeats_equal_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    assert sorted(map(tuple, QUERIES["op2_anchor_dedup"](spark, sf).collect())) == plain_repeats(rows, 20)


@pytest.mark.parametrize("width", [2, 5, 7])
def test_repeats_at_every_offset(spark, width):
    rng = random.Random(width)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))) for i in range(60)]
    got = repeated_passages(spark.createDataFrame(rows, "i long, t string"), "i", "t", width, group_chars=100).collect()
    assert sorted((r.i, r.n_words, r.n_removed, r.kept_text_sha256) for r in got) == plain_repeats(rows, width)
    assert all(sum(s.stop - s.start for s in r.removed) == r.n_removed for r in got)


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    union = Union(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                union.join(i, j)
    want = {r.doc_id: (f"{f:016x}", rows[union.root(i)].doc_id) for i, (r, f) in enumerate(zip(rows, fps))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op9_simhash_trees"](spark, sf).collect()}
    assert got == want


@pytest.mark.parametrize("radius", [0, 3, 12])
def test_tree_links_what_all_pairs_link(radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 2**63, (60, 1), dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (1500, 6)).astype(np.uint64)
    points = centres[rng.integers(0, 60, 1500)] ^ np.bitwise_xor.reduce(flips * (rng.random((1500, 6)) < 0.4), axis=1)[:, None]
    every = np.arange(len(points))
    union, found = Union(len(points)), Union(len(points))
    near = np.bitwise_count(points[:, None, 0] ^ points[None, :, 0]) <= radius
    for i, j in zip(*np.nonzero(near)):
        union.join(int(i), int(j))
    for i, j in spanning_links(len(points), near_links(points, radius, every, every)):
        assert near[i, j]
        found.join(i, j)
    assert [union.root(i) for i in every] == [found.root(i) for i in every]


def test_simhash_of_split_shards(spark):
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
    rows = []
    for i in range(120):
        words = list(base)
        words[rng.randrange(400)] = f"new{i}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(300))) for i in range(40)]
    frame = spark.createDataFrame(rows, "i long, t string")
    split = simhash_groups(frame, "i", "t", shard_rows=10).collect()
    assert sorted(map(tuple, split)) == sorted(map(tuple, simhash_groups(frame, "i", "t").collect()))
    wide = simhash_groups(frame, "i", "t", width=5, words=6, radius=68, blocks=27, shard_rows=30).collect()
    assert {r.i: r.component_id for r in wide} == {i: (0 if i < 200 else i) for i, _ in rows}


def test_near_copies_are_what_the_sets_say(spark):
    rng = random.Random(7)
    word = lambda: f"w{rng.randint(0, 10**7)}"
    rows = []
    for i in range(100):  # sets that agree to 0.8: one word in about 45 replaced
        words = [word() for _ in range(364)]
        other = list(words)
        for at in range(20, 360, 45):
            other[at] = word()
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    phrase = " ".join(word() for _ in range(5))
    rows += [(300 + i, " ".join([word() for _ in range(50)] + [phrase] * 10)) for i in range(20)]
    base = [word() for _ in range(360)]  # further apart: 0.7
    rows += [(400, " ".join(base)), (401, " ".join(word() if k % 28 == 20 else w for k, w in enumerate(base)))]
    rows += [(500, "one two"), (501, "ONE  two"), (501, "another text with its own few words"), (None, "one two")]
    sets = {}
    for i, text in rows[:222]:
        words = text.split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
    jaccard = lambda a, b: len(a & b) / len(a | b)
    assert all(jaccard(sets[2 * i], sets[2 * i + 1]) == 0.8 for i in range(100))
    assert jaccard(sets[400], sets[401]) < 0.8
    frame = spark.createDataFrame(rows, "i long, t string")
    for part_rows in (150, 1):
        got = similar_groups(frame, "i", "t", part_rows=part_rows).collect()
        assert len(got) == len(rows) - 1
        group = {r.i: r.component_id for r in got}
        assert sum(group[2 * i + 1] == 2 * i for i in range(100)) >= 97
        assert all(group[i] == i for i in [*range(300, 320), 400, 401, 500]) and group[501] == 500


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    data = centres[rng.integers(0, 12, 500)] + rng.normal(size=(500, 8)) * 0.25
    rows = [(i, [float(x) for x in v], int(rng.integers(0, 3))) for i, v in enumerate(data)]
    rows += [(500 + i, rows[0][1], rows[0][2]) for i in range(30)]
    odd = [
        (900, None, 1), (901, [], 1), (902, [0.0] * 8, 1), (903, [1.0, None] + [0.0] * 6, 1),
        (904, [float("nan")] + [1.0] * 7, 1), (905, [float("inf")] + [1.0] * 7, 1), (906, rows[0][1], None),
        (None, rows[0][1], rows[0][2]), (907, [1e-300] * 3, 1), (908, [1e300] * 3, 1),
    ]
    frame = spark.createDataFrame(rows + odd, "id long, vector array<double>, label int").withColumn("cell", F.lit(1))
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None])
    union = Union(len(rows))
    for i, j in zip(*np.nonzero(near)):
        union.join(int(i), int(j))
    want = {r[0]: (int(near[i].sum()) - 1, rows[union.root(i)][0], union.root(i) == i) for i, r in enumerate(rows)}
    want |= {i: (0, i, True) for i in range(900, 907)} | {907: (1, 907, True), 908: (1, 907, False)}
    for sizes in ({}, {"cell_rows": 20, "block_rows": 16}):
        got = near_vectors(frame, "id", "vector", "label", **sizes).collect()
        assert {r.id: (r.n_links, r.component_id, r.kept) for r in got if r.id is not None} == want
        assert [(r.n_links, r.component_id, r.kept) for r in got if r.id is None] == [(0, None, False)]
    assert near_vectors(frame.limit(0), "id", "vector", "label").count() == 0


def test_vectors_travel_once_to_a_part(spark, monkeypatch):
    """Vectors without structure visit nearly every cell; a part meets each of them once and alone."""
    rng = np.random.default_rng(8)
    data = rng.normal(size=(1_200, 64))
    data[600:640] = data[:40] + rng.normal(size=(40, 64)) * 0.03
    frame = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in enumerate(data)], "id long, vector array<float>, label int")
    stored, put = {}, spherical_cells.materialize
    monkeypatch.setattr(spherical_cells, "materialize", lambda df, purpose: stored.setdefault(purpose, put(df, purpose)))
    got = near_vectors(frame, "id", "vector", "label", cell_rows=40, block_rows=300).collect()
    assert {r.id: (r.n_links, r.component_id) for r in got} == {
        i: (1, i) if i < 40 else (1, i - 600) if 600 <= i < 640 else (0, i) for i in range(1_200)
    }
    placed = stored["vector-cells"]
    assert placed.count() == 1_200 and dict(placed.dtypes)["vector"] == "array<float>"
    assert placed.agg(F.avg(F.size("visits"))).first()[0] > 20


def test_vector_query_finds_all_links(spark, sf):
    rows = QUERIES["op7_spherical_cells"](spark, sf).collect()
    data = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    unit = np.array([r.embedding for r in data], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r.label for r in data])
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None])
    assert {r.vec_id: r.n_links for r in rows} == {r.vec_id: int(near[i].sum()) - 1 for i, r in enumerate(data)}


def test_mixing_stays_within_one_block(spark):
    rows = [(i, "x" * 10, s) for s, n in (("a", 600), ("b", 250), ("c", 90), (None, 60)) for i in range(n)]
    frame = spark.createDataFrame(rows, "i long, t string, s string").withColumn("slot", F.lit(0))
    weights = {"a": 50, "b": 30, "c": 15, "none": 5}
    got = mix_sources(frame, "i", "t", "s", weights=weights, period=100, block_chars=10).collect()
    assert sorted((r.i, r.mix_source) for r in got) == sorted((i, s or "none") for i, _, s in rows)
    slots = {r.slot: r.mix_source for r in got}
    assert len(slots) == len(rows)
    # Parts of the period: one for each source, the rest by weight.
    parts = {"a": 49, "b": 30, "c": 15, "none": 6}
    assert {s: sum(slots.get(t) == s for t in range(100)) for s in parts} == parts
    served = dict.fromkeys(weights, 0)
    for t in range(500):
        served[slots[t]] += 1
        assert all(abs(served[s] - (t + 1) * parts[s] / 100) < 1 for s in served)


def test_mixing_query_keeps_every_row(spark, sf):
    rows = QUERIES["op8_pfair_mixing"](spark, sf)
    assert rows.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    by_slot = rows.groupBy("slot").agg(F.countDistinct("mix_source", "block").alias("n"))
    assert by_slot.where("n <> 1").count() == 0


def check_packing(rows, tokens, capacity=4096):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = tokens[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, ids in tokens.items():
        assert sum(n for _, n in pieces[doc_id]) == len(ids)
        assert sorted(s for s, _ in pieces[doc_id]) == sorted(np.cumsum([0, *[n for _, n in sorted(pieces[doc_id])]])[:-1])
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    return padding


def test_packing_round_trip(spark, sf):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    tokens = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2] for r in rows}
    assert check_packing(QUERIES["op10_packing"](spark, sf).collect(), tokens) == 0


def test_packing_of_odd_texts(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    texts = [
        None, "", "  \n", "It's THE end.,. o'clock!! 3.14 a.b, c.", "ÉTAIT ΣΑΣ İstanbul é", "x<|endoftext|>y <|ENDOFTEXT|>",
        "nbsp here wide\x1cgap", "\U0001f600‍x 가가", "a," * 9000, "<|startoftext|>",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokens = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    rows = pack_documents(frame, "doc_id", "text", tokenizer_path("word_bpe_49k.json")).collect()
    assert check_packing(rows, tokens) == 0


def test_packing_follows_the_mixture(spark, tmp_path, monkeypatch):
    import corpus_pipeline as pipeline

    rows = []
    for s, n in (("a", 3200), ("b", 800), ("c", 200)):  # weights are roots of the sizes: 4, 2, 1
        start = len(rows)
        rows += [(start + i, f"some words of {s} number {i} " * 60, "en", s, 0) for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    source = {r[0]: r[3] for r in rows}
    monkeypatch.setattr(
        pipeline, "mix_sources", lambda *a, **b: mix_sources(*a, **b, block_chars=4_096)
    )
    pipeline.mixing(spark, frame.repartition(7), "").write.parquet(str(tmp_path / "mixed"))
    mixed = spark.read.parquet(str(tmp_path / "mixed"))
    packed = pipeline.packing(spark, mixed, "").collect()
    assert {r.doc_id for r in packed} == set(source)
    total = sum(r.length for r in packed)
    served, at = dict.fromkeys("abc", 0), 0
    ends = []
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        served[source[r.doc_id]] += r.length
        at += r.length
        ends.append((at / total, [served[s] / at for s in "abc"]))
    # c has 1 in 21 of the text and 1 in 7 of the mixture: it is used up after a third.
    for part, shares in ends:
        if 0.15 <= part <= 0.3:
            assert np.allclose(shares, [4 / 7, 2 / 7, 1 / 7], atol=0.06), (part, shares)


def test_tree_takes_the_first_bin_with_room():
    rng = random.Random(1)
    lengths = [rng.randint(1, 60) for _ in range(300)]
    tree, room = TournamentTree(len(lengths), 64), [64] * len(lengths)
    for length in lengths:
        want = next(i for i, r in enumerate(room) if r >= length)
        room[want] -= length
        assert tree.place(length) == want
    for n in (0, 1, 7, 300):
        sequences = pack_lengths([3 * x for x in lengths[:n]], 64)
        assert sum(p[2] for s in sequences for p in s) == 3 * sum(lengths[:n])
        short = [sum(p[2] for p in s) for s in sequences if sum(p[2] for p in s) != 64]
        assert len(short) == len(set(short)) and all(x & (x - 1) == 0 for x in short)


def test_odd_rows(spark, odd_documents, no_documents):
    n = odd_documents.count()
    repeats = repeated_passages(odd_documents, "doc_id", "text").collect()
    assert len(repeats) == n
    assert {(r.doc_id, r.n_removed) for r in repeats if r.n_removed} == {(6, 195), (7, 200)}
    groups = simhash_groups(odd_documents, "doc_id", "text").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in groups if r.fingerprint == "0" * 16) == [
        (False, 1, 1), (False, 2, 1), (False, 3, 1), (True, 0, 1),
    ]
    assert [r.component_id for r in groups if r.doc_id == 7] == [6, 6]
    mixed = mix_sources(odd_documents, "doc_id", "text", "source", keep=["lang"]).collect()
    assert len(mixed) == n and {r.mix_source for r in mixed} == {"a", "b", "none"}
    packed = pack_documents(odd_documents, "doc_id", "text", tokenizer_path("word_bpe_49k.json"))
    assert packed.select("doc_id").distinct().count() == 9
    for empty in (
        repeated_passages(no_documents, "doc_id", "text"),
        simhash_groups(no_documents, "doc_id", "text"),
        mix_sources(no_documents, "doc_id", "text", "source"),
        pack_documents(no_documents, "doc_id", "text", tokenizer_path("word_bpe_49k.json")),
    ):
        assert empty.count() == 0


def test_near_copies_of_shared_ids(spark):
    """Unlike texts under one id stay; copies under one id, or repeated rows, count once."""
    import corpus_pipeline as pipeline

    one, two, three = (" ".join(f"{w}{i}" for i in range(60)) for w in ("alpha", "beta", "gamma"))
    rows = [
        (1, one, "en", "a", 0), (1, two, "en", "a", 0), (2, one, "de", "b", 0), (3, three, "en", "a", 0),
        (3, three, "en", "a", 0), (3, three + " more", "en", "a", 0), (None, one, "en", "a", 0), (None, one, "en", "a", 0),
        (4, None, "en", "a", 0), (5, "", "en", "a", 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = [(r.doc_id, r.text) for r in pipeline.near_copies(spark, docs, "").collect()]
    third = min(three, three + " more", key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    want = [(None, one), (None, one), (1, one), (1, two), (3, third), (4, None)]
    assert sorted(kept, key=repr) == sorted(want, key=repr)


def test_proposals_find_near_copies_of_a_whole_table(spark):
    """Every pair of the table at 0.8 or more ends in one group."""
    from tallyfold.llm.near_copies import reaches, shingle_set, similar_groups

    import corpus_pipeline as pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    group = {r.doc_id: r.component_id for r in similar_groups(docs, "doc_id", "text", **pipeline.SIMILAR).collect()}
    sets = {r.doc_id: shingle_set(r.text, 5) for r in docs.collect()}
    holders = {}
    for i, shingles in sets.items():
        for h in shingles.tolist():
            holders.setdefault(h, []).append(i)
    pairs = {(a, b) for ids in holders.values() if len(ids) < 400 for a in ids for b in ids if a < b}
    near = [(a, b) for a, b in pairs if reaches(sets[a], sets[b], 80)]
    lost = [(a, b) for a, b in near if group[a] != group[b]]
    assert len(near) > 100 and len(lost) <= 0.01 * len(near), (len(near), len(lost))


def test_repeated_rows_are_spread_over_groups(spark):
    rows = [(1, "the same words again and again " * 20)] * 2_000
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    packed = pack_documents(frame, "doc_id", "text", tokenizer_path("word_bpe_49k.json"), group_chars=40_000)
    assert packed.select(F.expr("sequence_id >> 32").alias("g")).distinct().count() >= 20
    assert packed.agg(F.sum("length")).first()[0] == 2_000 * packed.first().doc_tokens


def test_rows_without_id_are_spread_over_pieces(spark):
    rows = [(None, f"text number {i}", "a") for i in range(200)]
    mixed = mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), "doc_id", "text", "source")
    assert mixed.select("place").distinct().count() == 200


def test_pipeline_stages(spark, sf, tmp_path, odd_documents, no_documents):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    kept = []
    for name, stage in pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs.select("doc_id").distinct().count())
        if name != "packing":
            assert docs.columns == pipeline.COLUMNS
            assert docs.count() == kept[-1]
            assert docs.where("n_chars <> length(text)").count() == 0
        if name == "privacy":
            from tests.llm.test_text_operators import plain_private

            assert all(not plain_private(r.text) for r in docs.collect())
    assert len(before) > kept[0] > kept[1] == kept[2] == kept[3] == kept[4]
    for _, stage in pipeline.STAGES:
        stage(spark, odd_documents, sf).write.format("noop").mode("overwrite").save()
        assert stage(spark, no_documents, sf).count() == 0
